"""Queries on chains of calls, the quality run and rules on plans, whose records are orders with their items as calls, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import calls, comparison, dataflow, plan_rules
from quern.plans.catalog import query, table
from quern.plans.records import CALL_SCHEMA
from quern.sources import schemas

#: Items by order, as SQL: pl is an item's place in its order.
_AT = """i AS (SELECT l_orderkey AS id, l_partkey AS part, l_suppkey AS supp, CAST(l_quantity AS INT) AS q, 'ship_' || lower(l_returnflag) AS name,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT), l_returnflag) - 1 AS pl FROM lineitem)"""


def _text(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with items: part, supp, q and name of each, in order; an order has a handful."""
    item = F.struct("l_linenumber", F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), F.col("l_quantity").cast("int").alias("q"), F.concat(F.lit("ship_"), F.lower("l_returnflag")).alias("name"))
    items = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "id").join(items, "id", "left")
    return orders.withColumn("items", F.coalesce("items", F.array().cast(items.schema["items"].dataType)))


def _messages(arguments, content, answered=lambda s, i: F.lit(True)) -> Column:
    """A turn with all items as calls, then a result for each that has one."""
    message = lambda role, text, own, of, name: F.struct(F.lit(role).alias("role"), text.alias("content"), own.alias("tool_calls"), of.alias("tool_call_id"), name.alias("name"))
    none = F.lit(None).cast("string")
    own = F.transform("items", lambda s, i: F.struct(_text("c", i).alias("id"), F.lit("function").alias("type"), F.struct(s["name"].alias("name"), arguments(s, i).alias("arguments")).alias("function")))
    results = F.filter(F.transform("items", lambda s, i: F.when(answered(s, i), message("tool", content(s, i), F.lit(None).cast(f"array<{schemas.CALL}>"), _text("c", i), s["name"]))), lambda m: m.isNotNull())
    return F.concat(F.array(message("assistant", none, own, none, none)), results)


def _mod(value: Column, n: int) -> Column:
    return F.pmod(value, F.lit(n))


@query(f"""WITH {_AT}, n AS (SELECT *, lead(id) OVER w IS NOT NULL AS there, lead(supp) OVER w AS next FROM i WINDOW w AS (PARTITION BY id ORDER BY pl))
SELECT n.id, CAST(pl AS BIGINT) AS source, CAST(pl + 1 AS BIGINT) AS target, CASE WHEN NOT there THEN 'missing_call' WHEN part % 13 = 0 THEN 'missing_result_key' WHEN n.id % 11 = 0 THEN 'missing_argument' WHEN n.id % 7 = 0 THEN 'transfer_mismatch' END AS failure
FROM n JOIN orders ON o_orderkey = n.id WHERE part % 29 <> 0 OR n.id % 2 = 0""")
def call_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as calls that hand their supplier to the next one; every seventh order hands on another, and some lose the key on either side."""
    orders = _orders(spark, sf_dir)
    before = lambda i: F.coalesce(F.get("items", i - 1)["supp"], F.lit(0)) + F.when(_mod(F.col("id"), 7) == 0, 1).otherwise(0)
    arguments = lambda s, i: F.when(_mod(F.col("id"), 11) == 0, _text('{"part":', s["part"], "}")).otherwise(_text('{"from": ', before(i), ', "part":', s["part"], "}"))
    content = lambda s, i: F.when(_mod(s["part"], 13) == 0, "{}").otherwise(_text('{"supp":', s["supp"], "}"))
    records = orders.select("id", _messages(arguments, content).alias("messages"))
    each = orders.select("id", F.posexplode("items").alias("at", "s")).where("s.part % 29 <> 0 OR id % 2 = 0")
    declared = each.select("id", F.col("at").cast("long").alias("source"), (F.col("at") + 1).cast("long").alias("target"), F.lit("supp").alias("result_key"), F.lit("from").alias("argument_key"))
    return calls.transfers(records, declared).select("id", "source", "target", "failure")


def _answered(s, i) -> Column:
    return ~((_mod(F.col("id"), 5) == 0) & (i == 1))


def _ran(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as records whose results partly differ from those of a run, and that run."""
    orders = _orders(spark, sf_dir)
    content = lambda s, i: F.when(_mod(s["part"], 19) == 0, "x{").otherwise(_text('{"supp": ', s["supp"] + F.when(_mod(s["part"], 17) == 0, 1).otherwise(0), "}"))
    kind = F.when(F.col("o_orderstatus") == "F", "local").when(F.col("o_orderstatus") == "O", "mock").otherwise("sandbox")
    metadata = F.struct(F.when(_mod(F.col("id"), 3) == 0, "multi_turn").otherwise("single_tool").alias("main_category"), F.struct(kind.alias("type")).alias("execution"))
    records = orders.select("id", "o_custkey", _messages(lambda s, i: _text('{"part":', s["part"], "}"), content, _answered).alias("messages"), metadata.alias("metadata"))
    each = orders.select("id", F.posexplode("items").alias("at", "s")).where("s.part % 23 <> 0")
    supp, raised = F.col("s.supp"), _mod(F.col("s.supp"), 10) == 0
    status = F.when(raised, None).when(_mod(supp, 9) == 0, "timeout").otherwise("passed")
    runs = each.select("id", _text("c", F.col("at")).alias("call"), status.alias("status"), _text('{"supp":', supp, "}").alias("result"), raised.alias("raised"), F.when(~raised, _text("f", supp)).alias("fixture"))
    return records, runs


_CHECKED = f"""{_AT}, v AS (SELECT *, part % 23 = 0 OR supp % 10 = 0 AS broken, CASE WHEN part % 23 = 0 OR supp % 10 = 0 THEN 'failed' WHEN supp % 9 = 0 THEN 'timeout' WHEN id % 5 = 0 AND pl = 1 OR part % 19 = 0 OR part % 17 = 0 THEN 'invalid_result' ELSE 'passed' END AS status,
  CASE WHEN part % 23 = 0 THEN 'not_executed' WHEN supp % 10 = 0 THEN 'exception' WHEN supp % 9 = 0 THEN NULL WHEN id % 5 = 0 AND pl = 1 THEN 'missing_tool_result_message' WHEN part % 19 = 0 THEN 'invalid_tool_result_json' WHEN part % 17 = 0 THEN 'recorded_result_mismatch' END AS reason,
  CASE WHEN part % 23 <> 0 AND supp % 10 <> 0 THEN 'f' || supp END AS fixture FROM i)"""


@query(f"WITH {_CHECKED} SELECT v.id, CAST(pl AS BIGINT) AS place, name, status, reason FROM v JOIN orders ON o_orderkey = v.id")
def recorded_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls run again, against what their records say they gave."""
    return calls.verified(*_ran(spark, sf_dir)).select("id", "place", "name", "status", "reason")


@query(f"""WITH {_CHECKED}, e AS (SELECT id, count(*) AS n, bool_or(broken) AS broken, arg_min(status, pl) FILTER (WHERE status <> 'passed') AS wrong, max(fixture) AS fixture FROM v GROUP BY id),
r AS (SELECT o_orderkey AS id, o_custkey, n IS NULL AS free, CASE o_orderstatus WHEN 'F' THEN 'local' WHEN 'O' THEN 'mock' ELSE 'sandbox' END AS kind, n, broken, wrong, fixture FROM orders LEFT JOIN e ON e.id = o_orderkey),
s AS (SELECT *, CASE WHEN free THEN 'not_applicable' ELSE kind END AS type, CASE WHEN free OR kind = 'sandbox' THEN 'not_called' WHEN broken THEN 'failed' ELSE coalesce(wrong, 'passed') END AS status FROM r),
g AS (SELECT *, CASE WHEN free THEN 'not_applicable' WHEN status = 'not_called' THEN 'not_run' WHEN status = 'passed' THEN 'passed' ELSE 'failed' END AS gate, CASE id % 4 WHEN 0 THEN 'failed' WHEN 1 THEN 'not_run' ELSE 'passed' END AS semantic, CASE WHEN o_custkey % 6 = 0 THEN 'failed' WHEN o_custkey % 6 = 1 THEN 'not_run' ELSE 'passed' END AS dup FROM s)
SELECT id, type, status, CASE WHEN status NOT IN ('passed', 'not_called') THEN 'quality_execution_failed' END AS error_code, CASE WHEN NOT free AND kind <> 'sandbox' AND n = 1 THEN fixture END AS fixture_id,
  concat_ws(',', CASE WHEN gate = 'failed' THEN 'execution' END, CASE WHEN semantic = 'failed' THEN 'semantic' END, CASE WHEN dup = 'failed' THEN 'duplicate' END) AS failures,
  concat_ws(',', CASE WHEN gate = 'not_run' THEN 'execution' END, CASE WHEN semantic = 'not_run' THEN 'semantic' END, 'language', CASE WHEN dup = 'not_run' THEN 'duplicate' END) AS pending,
  CASE WHEN free THEN 'not_applicable' ELSE 'passed' END AS tool_call, CASE WHEN id % 3 = 0 THEN 'passed' ELSE 'not_applicable' END AS turn_level FROM g""")
def quality_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality run over orders as records; judgments follow their numbers and duplicates their customers."""
    records, runs = _ran(spark, sf_dir)
    fate = lambda value, n: F.when(_mod(value, n) == 0, "failed").when(_mod(value, n) > 1, "passed")
    judgments = records.select("id", fate(F.col("id"), 4).alias("status")).where("status IS NOT NULL")
    twins = records.select("id", fate(F.col("o_custkey"), 6).alias("status")).where("status IS NOT NULL")
    out = dataflow.gated(records, runs, judgments, twins)
    listed = lambda c: F.array_join(c, ",")
    return out.select("id", "execution.type", "execution.status", "execution.error_code", "execution.fixture_id", listed("automatic_failures").alias("failures"), listed("pending_gates").alias("pending"), "validation.tool_call", "validation.turn_level")


@query("""WITH r AS (SELECT l_orderkey AS id, l_returnflag = 'A' AS done, l_suppkey % 4 = 0 AS paused, l_partkey % 7 = 0 AS broken FROM lineitem WHERE l_linestatus = 'O'), f AS (SELECT o_orderkey AS id, o_orderstatus = 'F' AS done FROM orders WHERE o_custkey % 3 = 0),
a AS (SELECT id, count(*) AS n, count_if(done) AS d, count_if(paused) AS p, count_if(broken) AS b FROM r GROUP BY id), m AS (SELECT id, n, d, p, b, f.id IS NOT NULL AS ref, f.done AS ok, a.id IS NOT NULL AS own FROM a FULL JOIN f USING (id))
SELECT id, unnest(list_filter([CASE WHEN n > 1 THEN 'duplicate_record_id' END, CASE WHEN d > 0 THEN 'accepted_record' END, CASE WHEN p > 0 THEN 'paused_source_type' END, CASE WHEN b > 0 THEN 'invalid_record' END, CASE WHEN ref AND NOT ok THEN 'unaccepted_reference' END, CASE WHEN ref AND own THEN 'id_collision' END], lambda x: x IS NOT NULL)) AS problem FROM m""")
def run_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open items as records by their orders' ids, some orders as references: what a run would refuse."""
    shape = lambda status, source: F.struct(F.struct(status.alias("status")).alias("review"), source.alias("source_type")).alias("metadata")
    items = table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'").withColumnRenamed("l_orderkey", "id")
    records = items.select("id", shape(F.when(F.col("l_returnflag") == "A", "accepted").otherwise("pending"), F.when(_mod(F.col("l_suppkey"), 4) == 0, "translated").otherwise("original_turkish")))
    references = table(spark, sf_dir, "orders").where("o_custkey % 3 = 0").select(F.col("o_orderkey").alias("id"), shape(F.when(F.col("o_orderstatus") == "F", "accepted").otherwise("pending"), F.lit("turkey_native")))
    return dataflow.refusals(records, references, items.where("l_partkey % 7 = 0").select("id"))


OUT_SCHEMA = '{"type":"object","properties":{"ok":{"type":"integer"}},"required":["ok"]}'


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of returned goods as functions, but for kind R."""
    names = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("ship_"), F.lower("l_returnflag")).alias("name")).distinct()
    return names.where("name <> 'ship_r'").select("name", F.lit(CALL_SCHEMA).alias("parameters"), F.lit(OUT_SCHEMA).alias("output_schema"))


@query(f"""WITH {_AT}, n AS (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM i), o AS (SELECT o_orderkey AS id, coalesce(n, 0) AS n FROM orders LEFT JOIN (SELECT id, count(*) AS n FROM i GROUP BY id) k ON k.id = o_orderkey),
x AS (SELECT n.*, pl < n - CAST(n > 1 AND n.id % 4 = 0 AS INT) AS listed FROM n JOIN orders ON o_orderkey = n.id)
SELECT id, 'BLUEPRINT_INTERNAL_MARKER' AS code, '$.user_goal' AS path FROM o WHERE id % 7 = 0 AND id % 5 <> 0
UNION ALL SELECT id, 'BLUEPRINT_INTERNAL_MARKER', '$.must_avoid[1]' FROM o WHERE id % 8 = 0 AND id % 5 <> 0
UNION ALL SELECT id, 'BLUEPRINT_RESULT_COUNT_MISMATCH', '$.expected_tool_result' FROM o WHERE n > 1 AND id % 4 = 0
UNION ALL SELECT id, 'BLUEPRINT_ORDER_TAG_MISMATCH', '$.execution_order' FROM o WHERE n > 1 AND (id % 6 < 3) <> (id % 3 = 0)
UNION ALL SELECT id, 'BLUEPRINT_NO_CALL_EXECUTION_INVALID', '$.metadata.intended_execution_type' FROM o WHERE id % 11 = 0
UNION ALL SELECT id, 'FUNCTION_NOT_IN_REGISTRY', '$.available_tools[2]' FROM o WHERE id % 2 = 0
UNION ALL SELECT id, 'FUNCTION_NOT_IN_REGISTRY', '$.expected_tool_calls[' || pl || '].function.arguments' FROM x WHERE name = 'ship_r'
UNION ALL SELECT id, 'EXPECTED_FUNCTION_NOT_AVAILABLE', '$.expected_tool_calls[' || pl || '].function.name' FROM x WHERE name = 'ship_r' AND id % 2 <> 0
UNION ALL SELECT id, 'ARG_SCHEMA_INVALID', '$.expected_tool_calls[' || pl || '].function.arguments.qty' FROM x WHERE name <> 'ship_r' AND q > 45
UNION ALL SELECT id, 'RESULT_TYPE', '$.expected_tool_result.ok' FROM x WHERE name <> 'ship_r' AND n = 1 AND id % 9 = 0
UNION ALL SELECT id, 'RESULT_REQUIRED', '$.expected_tool_result[' || pl || '].ok' FROM x WHERE name <> 'ship_r' AND n > 1 AND listed AND part % 10 = 0""")
def plan_rules_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as plans: their items are the expected calls, and numbers decide which rule breaks where."""
    c, n, id_ = F.col, F.size("items"), F.col("id")
    one = F.when(_mod(id_, 9) == 0, '{"ok":"x"}').otherwise('{"ok":1}')
    given = F.transform("items", lambda s: F.when(_mod(s["part"], 10) == 0, "{}").otherwise(_text('{"ok":', s["part"], "}")))
    several = _text("[", F.array_join(F.slice(given, F.lit(1), n - F.when(_mod(id_, 4) == 0, 1).otherwise(0)), ","), "]")
    plans = _orders(spark, sf_dir).select(
        "id", F.when(n > 1, "multi_tool").otherwise("single_tool").alias("category"),
        F.array_compact(F.array(F.when(_mod(id_, 3) == 0, F.lit("parallel_tool")), F.when(_mod(id_, 5) == 0, F.lit("internal_marker_topic")))).alias("tags"),
        F.when(_mod(id_, 7) == 0, "a simulation").otherwise(c("o_orderpriority")).alias("goal"), F.lit(None).cast("string").alias("ending"),
        F.array(F.lit("haste"), F.when(_mod(id_, 8) == 0, "a simulation").otherwise("waste")).alias("avoid"),
        F.array_compact(F.array(F.lit("ship_a"), F.lit("ship_n"), F.when(_mod(id_, 2) == 0, F.lit("ship_r")))).alias("tools"),
        F.transform("items", lambda s: F.struct(s["name"].alias("name"), _text('{"part":', s["part"], ',"qty":', s["q"], "}").alias("arguments"))).alias("calls"),
        F.when(n == 1, one).when(n > 1, several).alias("result"), F.when(_mod(id_, 6) < 3, "parallel").otherwise("any").alias("execution_order"),
        F.when(_mod(id_, 11) == 0, "direct_answer").otherwise("tool_call").alias("behavior"), F.lit("local").alias("execution_type"),
    )
    return plan_rules.plan_issues(plans, _registry(spark, sf_dir))


@query(f"""WITH {_AT}, x AS (SELECT i.* FROM i JOIN orders ON o_orderkey = i.id)
SELECT o_orderkey AS id, 'BENCHMARK_DECISION_INCONSISTENT' AS code, '$.expected.decision' AS path FROM orders WHERE CASE o_orderstatus WHEN 'F' THEN o_orderkey % 4 = 0 WHEN 'O' THEN o_orderkey % 4 <> 2 ELSE true END
UNION ALL SELECT id, 'EXPECTED_FUNCTION_NOT_EXPOSED', '$.expected.tool_calls[' || pl || '].function.name' FROM x WHERE name = 'ship_n' AND id % 3 = 0 OR name = 'ship_r'
UNION ALL SELECT id, 'FUNCTION_NOT_IN_REGISTRY', '$.expected.tool_calls[' || pl || '].function.arguments' FROM x WHERE name = 'ship_r'
UNION ALL SELECT id, 'ARG_SCHEMA_INVALID', '$.expected.tool_calls[' || pl || '].function.arguments.qty' FROM x WHERE name <> 'ship_r' AND q > 45""")
def benchmark_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as benchmark rows, whose state gives the category and whose number the decision."""
    category = F.when(F.col("o_orderstatus") == "F", "single_tool").when(F.col("o_orderstatus") == "O", "no_tool")
    decision = F.when((_mod(F.col("id"), 4) == 0) | (_mod(F.col("id"), 4) == 2) & (F.col("o_orderstatus") == "O"), F.when(_mod(F.col("id"), 4) == 2, "cannot_answer").otherwise("request_information")).otherwise("tool_call")
    exposed = F.when(_mod(F.col("id"), 3) == 0, F.array(F.lit("ship_a"))).otherwise(F.array(F.lit("ship_a"), F.lit("ship_n")))
    own = F.transform("items", lambda s: F.struct(s["name"].alias("name"), _text('{"part":', s["part"], ',"qty":', s["q"], "}").alias("arguments")))
    rows = _orders(spark, sf_dir).select("id", category.alias("category"), decision.alias("decision"), exposed.alias("exposed"), own.alias("calls"))
    return plan_rules.benchmark_issues(rows, _registry(spark, sf_dir))


@query("""WITH t AS (SELECT p_partkey AS k, p_partkey % 3 = 0 AS real, p_partkey % 5 < 3 AS http, p_partkey % 4 = 0 AS open, p_partkey % 6 = 0 AS var, p_size FROM part)
SELECT CAST(k AS VARCHAR) AS tool_id, unnest(list_filter([CASE WHEN real AND NOT http THEN 'REAL_API_HTTP_REQUIRED' END, CASE WHEN http AND NOT real THEN 'UNUSED_HTTP_CONTRACT' END, CASE WHEN http AND CASE WHEN open THEN var OR p_size % 7 = 0 ELSE NOT var END THEN 'HTTP_AUTH_INVALID' END,
  CASE WHEN http AND NOT open AND var AND p_size % 3 = 0 THEN 'HTTP_CREDENTIAL_UNDECLARED' END, CASE WHEN http AND p_size % 8 = 0 THEN 'HTTP_QUERY_MAP_INCOMPLETE' END, CASE WHEN http AND p_size > 40 THEN 'REAL_API_SIDE_EFFECT_FORBIDDEN' END], lambda x: x IS NOT NULL)) AS code FROM t""")
def http_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as tools with HTTP contracts."""
    k, size = F.col("p_partkey"), F.col("p_size")
    var = F.when(_mod(k, 6) == 0, "KEY")
    query_map = F.when(_mod(size, 8) == 0, F.create_map(F.lit("part"), F.lit("p"))).otherwise(F.create_map(F.lit("qty"), F.lit("q"), F.lit("part"), F.lit("p")))
    http = F.struct(F.when(_mod(k, 4) == 0, "none").otherwise("api_key").alias("auth_type"), var.alias("env_var"), F.when(var.isNotNull(), "X-Key").alias("header"), F.when(_mod(size, 7) == 0, "Bearer").otherwise("").alias("prefix"), query_map.alias("query_map"))
    kinds = F.when(_mod(k, 3) == 0, F.array(F.lit("local"), F.lit("real_api"))).otherwise(F.array(F.lit("local")))
    credentials = F.when(_mod(size, 3) == 0, F.array(F.lit("OTHER"))).otherwise(F.array(F.lit("KEY")))
    registry = table(spark, sf_dir, "part").select(k.cast("string").alias("tool_id"), F.lit(CALL_SCHEMA).alias("parameters"), kinds.alias("supported_types"), F.when(_mod(k, 5) < 3, http).alias("http"), credentials.alias("credentials"), (size > 40).alias("side_effects"))
    return plan_rules.http_issues(registry)


#: What a raw event has to look like.
EVENT_SCHEMA = '{"type":"object","properties":{"id":{"type":"integer"},"kind":{"enum":["click","view","error"]},"version":{"const":"0.1.0"},"tag":{"type":"string","pattern":"^t_[0-9]+$"},"k":{"type":"integer","maximum":80}},"required":["id","kind"],"additionalProperties":false}'


@query("""WITH e AS (SELECT event_id AS id, event_type AS kind, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT id, unnest(list_filter([CASE WHEN id % 9 = 0 THEN 'SCHEMA_REQUIRED $.kind' WHEN kind NOT IN ('click', 'view', 'error') THEN 'SCHEMA_ENUM $.kind' END, CASE WHEN id % 5 = 0 THEN 'SCHEMA_CONST $.version' END, CASE WHEN user_id % 4 = 0 THEN 'SCHEMA_PATTERN $.tag' WHEN user_id % 4 = 1 THEN 'SCHEMA_TYPE $.tag' END,
  CASE WHEN k > 80 THEN 'SCHEMA_INVALID $.k' END, CASE WHEN id % 7 = 0 THEN 'SCHEMA_ADDITIONAL_PROPERTY $.more' END], lambda x: x IS NOT NULL)) AS issue FROM e WHERE id % 13 <> 0 UNION ALL SELECT id, 'SCHEMA_INVALID $' FROM e WHERE id % 13 = 0""")
def record_schema_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw records against their schema; every thirteenth is cut short."""
    id_, user = F.col("event_id"), F.col("user_id")
    kind = F.when(_mod(id_, 9) == 0, "").otherwise(_text('"kind":"', F.col("event_type"), '",'))
    tag = F.when(_mod(user, 4) == 0, '"tag":"x",').when(_mod(user, 4) == 1, '"tag":3,').otherwise(_text('"tag":"t_', user, '",'))
    k = F.variant_get(F.parse_json("props"), "$.k", "long")
    raw = _text('{"id":', id_, ",", kind, tag, '"version":"', F.when(_mod(id_, 5) == 0, "0.2.0").otherwise("0.1.0"), '","k":', k, F.when(_mod(id_, 7) == 0, ',"more":1').otherwise(""), F.when(_mod(id_, 13) == 0, "").otherwise("}"))
    found = plan_rules.raw_schema_issues(table(spark, sf_dir, "events").select(id_.alias("id"), raw.alias("raw")), EVENT_SCHEMA)
    return found.select("id", F.concat_ws(" ", "code", "path").alias("issue"))


_COMPARED = """e AS (SELECT o_orderkey AS id, m.model, o_custkey AS c, 'tctr_' || CASE WHEN o_custkey % 2 = 0 THEN 'ot' ELSE 'tn' END || '_' || printf('%06d', row_number() OVER (PARTITION BY m.model, o_custkey % 2 ORDER BY o_orderkey)) AS record_id,
  o_orderkey % 10 <> 0 OR m.model = 'strong' AS made, o_orderkey % 13 = 0 AS broken, o_orderkey % 7 <> 0 AS seen, o_orderkey % 11 = 0 AS mute, CASE WHEN o_orderkey % CASE m.model WHEN 'strong' THEN 4 ELSE 3 END > 0 THEN 'pass' ELSE 'revise' END AS verdict
  FROM orders, (VALUES ('cheap'), ('strong')) m(model)),
s AS (SELECT *, made AND NOT broken AS ok, made AND NOT broken AND seen AND NOT mute AS good, made AND NOT broken AND seen AND mute AS lost FROM e)"""


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as plans for two models, whose generations and judgments follow the orders' numbers."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "id")
    key, strong = F.col("id"), F.col("model") == "strong"
    each = orders.withColumn("model", F.explode(F.array(F.lit("cheap"), F.lit("strong"), F.lit("absent"))))
    whole = lambda a, b: F.create_map(F.lit("input_tokens"), a.cast("long"), F.lit("output_tokens"), b.cast("long"))
    generations = each.where((_mod(key, 10) != 0) | strong).select("id", "model", F.when(_mod(key, 13) == 0, "refused").alias("error"), whole(F.col("o_custkey"), _mod(key, 100)).alias("usage"))
    verdict = F.when(_mod(key, 3) > 0, "pass").otherwise("revise")
    scores = F.create_map(F.lit("clarity"), (_mod(key, 5) + 1).cast("double"), F.lit("tone"), (_mod(F.col("o_custkey"), 5) + 1).cast("double"))
    judgments = each.where(_mod(key, 7) != 0).select("id", "model", F.when(_mod(key, 11) == 0, "timeout").alias("error"), F.when(strong, F.when(_mod(key, 4) > 0, "pass").otherwise("revise")).otherwise(verdict).alias("verdict"), scores.alias("scores"), whole(key, F.lit(7)).alias("usage"))
    plans = orders.select("id", F.when(_mod(F.col("o_custkey"), 2) == 0, "original_turkish").otherwise("turkey_native").alias("source_type"))
    return comparison.entries(plans, ["cheap", "strong"], generations, judgments)


@query(f"""WITH {_COMPARED} SELECT id, model, record_id, CASE WHEN ok THEN 'passed' ELSE 'failed' END AS status, CASE WHEN NOT made THEN 'not_generated' WHEN broken THEN 'refused' END AS error,
  CASE WHEN good THEN 'passed' WHEN lost THEN 'failed' END AS judge_status, CASE WHEN good THEN verdict END AS verdict FROM s""")
def comparison_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of two models made of each plan, and what a judge says of it."""
    return _compared(spark, sf_dir).select("id", "model", "record_id", "status", "error", "judge_status", "verdict")


@query(f"""WITH {_COMPARED}, d AS (SELECT model, unnest([id % 5 + 1, c % 5 + 1]) AS x, unnest([1, 2]) AS dimension FROM s WHERE good),
m AS (SELECT model, (20000 * sum(x) + count(*)) // (2 * count(*)) AS m FROM d GROUP BY model, dimension), o AS (SELECT model, ((2 * sum(m) + count(*)) // (2 * count(*))) / 10000.0 AS mean FROM m GROUP BY model)
SELECT model, count(*) AS total, count_if(ok) AS generation_passed, count_if(NOT ok) AS generation_failed, count_if(lost) AS judge_failed, count_if(good AND verdict = 'pass') AS passes, count_if(good AND verdict = 'revise') AS revised,
  CAST(sum(c) FILTER (WHERE ok) AS BIGINT) AS input_tokens, CAST(sum(id % 100) FILTER (WHERE ok) AS BIGINT) AS output_tokens, CAST(sum(id) FILTER (WHERE good) AS BIGINT) AS judge_tokens, any_value(mean) AS mean FROM s JOIN o USING (model) GROUP BY model""")
def comparison_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models over the same plans: what passed, verdicts, tokens and mean scores."""
    out = comparison.summary(_compared(spark, sf_dir))
    return out.select("model", "total", "generation_passed", "generation_failed", "judge_failed", "passes", F.col("verdicts")["revise"].alias("revised"), F.col("generation_usage")["input_tokens"].alias("input_tokens"), F.col("generation_usage")["output_tokens"].alias("output_tokens"), F.col("judge_usage")["input_tokens"].alias("judge_tokens"), "mean")
