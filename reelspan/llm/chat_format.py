"""Chat messages with linked tool calls as canonical JSON, by DataFrame functions only.

An assistant message whose text is a JSON object with ``tool_calls`` makes
calls: each has ``id``, ``name`` and ``arguments`` (an object, or one written as
a string). A message whose text is a JSON object with ``tool_call_id`` is a
result. A system message whose text is a JSON object with ``tools`` declares the
tools of its conversation, against which calls are validated. Any other text is
content as it stands. Calls and results are joined by conversation and identifier,
so no conversation is gathered in one place, and every message keeps its own row.
Messages without either pass without a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parameters of known tools; names are matched exactly. kind: string, integer, number, boolean,
#: object, array, null, several of them with commas between, or a null for any.
SCHEMA = "name string, parameter string, kind string, required boolean"
_CALLS = "array<struct<id:string,name:string,arguments:string>>"
#: What variant type names stand for, by kind.
_KINDS = {
    "string": r"^STRING$",
    "integer": r"^BIGINT$",
    "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "boolean": r"^BOOLEAN$",
    "object": r"^OBJECT<",
    "array": r"^ARRAY<",
    "null": r"^VOID$",
}


def _json_object(text: Column) -> Column:
    """The text as a variant if it is a JSON object, else null. Only texts that look
    like one are parsed."""
    looks = F.trim(text).startswith("{") & F.trim(text).endswith("}")
    return F.when(looks, F.try_parse_json(text))


def tool_calls(messages: DataFrame) -> DataFrame:
    """conv_id, call_turn, call_text, call_index, call_id, name, arguments of every call of
    ``messages`` (conv_id, turn, role, text). Repeated rows make their calls once;
    call_text, a hash of the text, tells messages of one turn apart."""
    asked = messages.filter((F.col("role") == "assistant") & F.col("text").contains('"tool_calls"')).dropDuplicates(["conv_id", "turn", "text"])
    found = asked.select("conv_id", F.col("turn").alias("call_turn"), F.xxhash64("text").alias("call_text"), F.from_json(F.try_variant_get(_json_object(F.col("text")), "$.tool_calls", "string"), _CALLS).alias("calls"))
    each = found.select("conv_id", "call_turn", "call_text", F.posexplode("calls").alias("call_index", "call"))
    return each.filter("call.id IS NOT NULL").select("conv_id", "call_turn", "call_text", "call_index", F.col("call.id").alias("call_id"), F.col("call.name").alias("name"), F.col("call.arguments").alias("arguments"))


def declared_tools(messages: DataFrame) -> DataFrame:
    """conv_id and the columns of ``SCHEMA`` of the tools that system messages of ``messages``
    (conv_id, turn, role, text) declare: JSON objects whose ``tools`` lists tools, each with
    ``name`` and ``parameters`` or with both in a ``function``. ``parameters`` is a JSON schema
    (or one written as a string), of which ``properties``, their ``type`` and ``required``
    count. A conversation has a tool by its first declaration of the name, wherever it stands;
    entries that are not tools are passed over."""
    asked = messages.filter((F.col("role") == "system") & F.col("text").contains('"tools"'))
    each = asked.select("conv_id", "turn", F.xxhash64("text").alias("_text"), F.posexplode(F.try_variant_get(_json_object(F.col("text")), "$.tools", "array<variant>")).alias("_at", "_tool"))
    part = lambda name: F.coalesce(F.try_variant_get("_tool", f"$.function.{name}", "string"), F.try_variant_get("_tool", f"$.{name}", "string"))
    named = each.select("conv_id", "turn", "_text", "_at", part("name").alias("name"), F.try_parse_json(part("parameters")).alias("_given")).filter(F.col("name").isNotNull())
    first = Window.partitionBy("conv_id", "name").orderBy("turn", "_text", "_at")
    tools = named.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    own = F.from_json(F.try_variant_get("_given", "$.properties", "string"), "map<string,string>")
    required = F.array_compact(F.coalesce(F.from_json(F.try_variant_get("_given", "$.required", "string"), "array<string>"), F.array().cast("array<string>")))
    tools = tools.select("conv_id", "name", F.coalesce(own, F.create_map().cast("map<string,string>")).alias("_own"), required.alias("_required"))
    listed = tools.withColumn("parameter", F.explode_outer(F.array_union(F.map_keys("_own"), "_required")))
    kind = F.try_variant_get(F.try_parse_json(F.try_element_at("_own", F.col("parameter"))), "$.type", "string")
    return listed.select("conv_id", "name", "parameter", kind.alias("kind"), F.coalesce(F.array_contains("_required", F.col("parameter")), F.lit(False)).alias("required"))


def validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls`` with valid: whether the tool is known, its required parameters are
    there, and those given are known and of their kinds. A tool without
    parameters is listed with a null parameter. ``schemas`` hold for all conversations,
    or with a conv_id for that one."""
    # a map, since paths can't name every parameter
    parsed = calls.withColumn("_given", F.try_variant_get(F.try_parse_json("arguments"), "$", "map<string,variant>")).withColumn("_names", F.map_keys("_given"))
    fits = F.col("kind").isNull()
    kind_of = F.schema_of_variant(F.try_element_at("_given", F.col("parameter")))
    for kind, pattern in _KINDS.items():
        fits = fits | F.col("kind").rlike(rf"\b{kind}\b") & kind_of.rlike(pattern)
    there = F.array_contains("_names", F.col("parameter"))
    good = F.col("parameter").isNull() | F.when(there, fits).otherwise(~F.col("required"))
    key = ["conv_id", "call_turn", "call_text", "call_index"]
    checked = (
        parsed.join(schemas, [c for c in ("conv_id", "name") if c in schemas.columns])
        .groupBy(*key)
        .agg(F.bool_and(F.coalesce(good, F.lit(False))).alias("_good"), F.collect_set("parameter").alias("_known"), F.first("_names").alias("_names"))
        .select(*key, (F.col("_good") & F.col("_names").isNotNull() & (F.size(F.array_except("_names", "_known")) == 0)).alias("valid"))
    )
    return calls.join(checked, key, "left").withColumn("valid", F.coalesce("valid", F.lit(False)))


def _formatted(rows: DataFrame, message: Column, order_turn: Column, order_rank: Column, n_calls: Column, n_invalid: Column, linked: Column) -> DataFrame:
    return rows.select("conv_id", "turn", "role", order_turn.alias("order_turn"), order_rank.cast("int").alias("order_rank"), n_calls.cast("long").alias("n_calls"), n_invalid.cast("long").alias("n_invalid"), linked.cast("boolean").alias("linked"), message.alias("message"))


def chat_messages(messages: DataFrame, schemas: DataFrame | None = None) -> DataFrame:
    """One row per input row: conv_id, turn, role, order_turn, order_rank, n_calls,
    n_invalid, linked, message.

    (order_turn, order_rank, turn) is a topological order within a conversation:
    turns in order, but a result that stands before its call moves to right after
    it, in the order of the calls. n_calls and n_invalid count an assistant
    message's calls and those whose arguments break their tool's schema; without
    ``schemas`` a conversation's tools are those that its system messages declare
    (``declared_tools``), and calls of other tools are invalid. linked says
    of a result whether its call exists, and is null for other messages; of
    calls that share an identifier the first is meant. Messages of one turn have
    their own calls each, and repeated rows the same. message is JSON with
    sorted keys and no spaces: ``content`` and ``role``, or ``role`` and
    ``tool_calls`` (arguments as canonical JSON text), or ``content``, ``name``,
    ``role`` and ``tool_call_id``. Null texts are empty content, null roles are
    "user", rows with a null conversation or turn stay and are linked with
    nothing; repeated rows each keep a row; other columns are ignored; an empty
    table gives an empty result.
    """
    base = messages.select("conv_id", "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    schemas = declared_tools(base) if schemas is None else schemas
    plain = F.to_json(F.struct(F.col("text").alias("content"), "role"))
    # most messages neither call nor answer a tool; they need no join
    special = F.col("text").contains('"tool_call')
    simple = _formatted(base.filter(~special), plain, F.col("turn"), F.lit(0), F.lit(0), F.lit(0), F.lit(None))
    tooled = base.filter(special).withColumn("_text", F.xxhash64("text"))
    calls = validated(tool_calls(tooled), schemas)
    # numbered by the calls of one identifier of one conversation: a handful
    first = Window.partitionBy("conv_id", "call_id").orderBy("call_turn", "call_index", "call_text")
    target = calls.withColumn("_n", F.row_number().over(first)).filter("_n = 1").select(F.col("conv_id").alias("_conv"), F.col("call_id").alias("_call"), "call_turn", "call_index", F.col("name").alias("call_name"))
    canonical = F.coalesce(F.to_json(F.try_parse_json("arguments")), F.col("arguments"), F.lit("{}"))
    one = F.struct("call_index", F.to_json(F.struct(F.struct(canonical.alias("arguments"), F.col("name")).alias("function"), F.col("call_id").alias("id"), F.lit("function").alias("type"))).alias("json"))
    made = calls.groupBy(F.col("conv_id").alias("_mconv"), F.col("call_turn").alias("_mturn"), F.col("call_text").alias("_mtext")).agg(F.count("*").alias("_calls"), F.count_if(~F.col("valid")).alias("_invalid"), F.sort_array(F.collect_list(one)).alias("_made"))

    body = F.when(F.col("text").contains('"tool_call_id"'), _json_object(F.col("text")))
    marked = tooled.withColumn("_result_id", F.try_variant_get(body, "$.tool_call_id", "string")).withColumn("_result", F.when(F.col("_result_id").isNotNull(), F.coalesce(F.try_variant_get(body, "$.content", "string"), F.lit(""))))
    linked = marked.join(target, (F.col("conv_id") == F.col("_conv")) & (F.col("_result_id") == F.col("_call")), "left")
    whole = linked.join(made, (F.col("conv_id") == F.col("_mconv")) & (F.col("turn") == F.col("_mturn")) & (F.col("_text") == F.col("_mtext")) & (F.col("role") == "assistant"), "left")

    moved = F.col("call_turn").isNotNull() & (F.col("turn") <= F.col("call_turn"))
    result = F.to_json(F.struct(F.col("_result").alias("content"), F.col("call_name").alias("name"), "role", F.col("_result_id").alias("tool_call_id")))
    asking = F.concat(F.lit('{"role":"assistant","tool_calls":['), F.array_join(F.transform("_made", lambda c: c["json"]), ","), F.lit("]}"))
    return simple.unionByName(_formatted(
        whole,
        F.when(F.col("_calls") > 0, asking).when(F.col("_result_id").isNotNull(), result).otherwise(plain),
        F.when(moved, F.col("call_turn")).otherwise(F.col("turn")),
        F.when(moved, F.col("call_index") + 1).otherwise(0),
        F.coalesce("_calls", F.lit(0)),
        F.coalesce("_invalid", F.lit(0)),
        F.when(F.col("_result_id").isNotNull(), F.col("call_turn").isNotNull()),
    ))
