"""Schemas of conversation records; open objects stay JSON text."""

from __future__ import annotations

CALL = "STRUCT<id:STRING,type:STRING,function:STRUCT<name:STRING,arguments:STRING>>"
MESSAGE = f"STRUCT<role:STRING,content:STRING,tool_calls:ARRAY<{CALL}>,tool_call_id:STRING,name:STRING>"
TOOL = "STRUCT<type:STRING,function:STRUCT<name:STRING,description:STRING,parameters:STRING>>"
EVENT = "STRUCT<action:STRING,timestamp:STRING,actor_id:STRING,details:STRING,from_execution_type:STRING,to_execution_type:STRING>"
PROVENANCE = f"STRUCT<source_dataset:STRING,source_example_id:STRING,upstream_source:STRING,source_split:STRING,transformation_history:ARRAY<{EVENT}>,generator_model:STRING,generator_version:STRING,license:STRING,license_chain:ARRAY<STRING>>"
GATES = ("json", "schema", "tool_call", "execution", "semantic", "turn_level", "language", "duplicate")
VALIDATION = f"STRUCT<{','.join(f'{g}:STRING' for g in GATES)}>"
METADATA = f"STRUCT<main_category:STRING,secondary_tags:ARRAY<STRING>,source_type:STRING,domain:STRING,difficulty:STRING,final_response_method:STRING,provenance:{PROVENANCE},execution:STRUCT<type:STRING,status:STRING,fixture_id:STRING,timeout_ms:BIGINT,error_code:STRING>,validation:{VALIDATION},review:STRUCT<status:STRING,notes:STRING>>"
RECORD = f"schema_version STRING, tool_registry_version STRING, id STRING, metadata {METADATA}, tools ARRAY<{TOOL}>, messages ARRAY<{MESSAGE}>"
EXPECTED = "STRUCT<decision:STRING,missing_parameters:ARRAY<STRING>,tool_calls:ARRAY<STRUCT<function:STRUCT<name:STRING,arguments:STRING>>>,response:STRING>"
BENCHMARK = f"{RECORD}, expected {EXPECTED}"
REGISTRY = "tool_registry_version STRING, tool_id STRING, tool_version STRING, domain STRING, function STRUCT<name:STRING,description:STRING,parameters:STRING>, output_schema STRING, execution STRUCT<default_type:STRING,supported_types:ARRAY<STRING>,fixture_ids:ARRAY<STRING>,resettable:BOOLEAN>, risks STRUCT<side_effects:BOOLEAN>"
