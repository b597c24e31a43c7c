"""Operators that prepare training text at scale. Nothing else in the package imports this one."""
