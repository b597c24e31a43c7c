"""Readers: records with line numbers, snapshots, foreign datasets."""
