"""Tool calls linked to their results, ordered, validated and serialised, natively.

Calls and results meet in a hash join on (conversation, identifier). A call may name the
call whose result it uses; the links form chains, and each call's level is found by pointer
doubling: in every round a call looks two, four, eight calls back, so rounds grow with the
logarithm of the longest chain and no conversation is gathered in one task. Sorting a
conversation by (level, position) puts every call after what it depends on. Arguments are
parsed into variants, checked against the tool's schema, and written as canonical JSON: keys
in code point order, no white space.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import table, whole_text
from cohortloom.sources.storage import materialize

KEY = ["conv_id", "call_id"]
#: Variant type names of each JSON type, as the start of what schema_of_variant says.
TYPES = {
    "string": ("STRING",),
    "integer": ("BIGINT",),
    "number": ("BIGINT", "DECIMAL", "DOUBLE"),
    "boolean": ("BOOLEAN",),
    "object": ("OBJECT",),
    "array": ("ARRAY",),
}


@dataclass(frozen=True)
class Field:
    """What a schema asks of one argument; bounds hold for numbers, lengths for strings."""

    type: str
    required: bool = True
    minimum: float | None = None
    maximum: float | None = None
    min_length: int | None = None
    max_length: int | None = None
    choices: tuple[str, ...] | None = None


Schema = dict[str, Field]


def _faults(arguments: Column, parsed: Column, schema: Schema) -> Column:
    """Texts of what is wrong with the arguments of one tool, an empty array if nothing is."""
    faults = []
    for name, field in schema.items():
        value = F.try_variant_get(parsed, f"$['{name}']", "variant")
        kind = F.schema_of_variant(value)
        absent = value.isNull()
        if field.required:
            faults.append(F.when(absent, F.lit(f"{name}: missing")))
        right = F.lit(False)
        for start in TYPES[field.type]:
            right = right | kind.startswith(start)
        faults.append(F.when(~absent & ~right, F.lit(f"{name}: not {field.type}")))
        text = F.try_variant_get(value, "$", "string")
        if field.type in ("integer", "number"):
            number = F.try_variant_get(value, "$", "double")
            if field.minimum is not None:
                faults.append(F.when(right & (number < field.minimum), F.lit(f"{name}: too small")))
            if field.maximum is not None:
                faults.append(F.when(right & (number > field.maximum), F.lit(f"{name}: too large")))
        if field.type == "string":
            length = F.char_length(text)
            if field.min_length is not None:
                short = right & (length < field.min_length)
                faults.append(F.when(short, F.lit(f"{name}: too short")))
            if field.max_length is not None:
                long = right & (length > field.max_length)
                faults.append(F.when(long, F.lit(f"{name}: too long")))
            if field.choices is not None:
                other = right & ~text.isin(*field.choices)
                faults.append(F.when(other, F.lit(f"{name}: not allowed")))
    known = F.array(*[F.lit(name) for name in schema]) if schema else F.array().cast("array<string>")
    others = F.array_sort(F.array_except(F.json_object_keys(arguments), known))
    unknown = F.transform(others, lambda name: F.concat(name, F.lit(": unknown")))
    return F.concat(F.array_compact(F.array(*faults)) if faults else known, unknown)


def argument_faults(name: Column, arguments: Column, schemas: dict[str, Schema]) -> Column:
    """Faults of a call's arguments under the schema of its tool."""
    parsed = F.try_parse_json(arguments)
    found = F.array(F.lit("unknown tool"))
    for tool, schema in sorted(schemas.items()):
        found = F.when(name == tool, _faults(arguments, parsed, schema)).otherwise(found)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    return F.when(~is_object, F.array(F.lit("arguments: not an object"))).otherwise(found)


def call_levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of calls with unique keys (conv_id, call_id, after).

    The level is the number of calls before it in its chain. A call that names one that isn't
    there starts a chain; calls in a circle, or after one, have no level.
    """
    at = ["conv_id", F.col("call_id").alias("after")]
    chained = calls.where("after IS NOT NULL").join(calls.select(*at), ["conv_id", "after"], "left_semi")
    steps = chained.select("conv_id", "call_id", F.col("after").alias("up"), F.lit(1).cast("long").alias("level"))
    first = calls.join(chained.select(*KEY), KEY, "left_anti").select(
        *KEY, F.lit(None).cast("string").alias("up"), F.lit(0).cast("long").alias("level")
    )
    state = materialize(steps.unionByName(first), "call-chains")
    longest, reach = state.where("up IS NOT NULL").count(), 1
    while reach <= longest and not state.where("up IS NOT NULL").isEmpty():
        # each call takes over what the call it points at points at; a call that has reached
        # its chain's start keeps still
        above = state.select(
            "conv_id",
            F.col("call_id").alias("up"),
            F.col("up").alias("next"),
            F.col("level").alias("more"),
        )
        moved = state.where("up IS NOT NULL").join(above, ["conv_id", "up"])
        moved = moved.select(*KEY, F.col("next").alias("up"), (F.col("level") + F.col("more")).alias("level"))
        state = materialize(state.where("up IS NULL").unionByName(moved), "call-chains")
        reach *= 2
    return state.select(*KEY, F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def _first_by_key(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The first row of each key by the given columns, and the number of rows it has.

    The pick is a minimum, formed map-side; rows without a key are passed over.
    """
    named = rows.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
    picked = named.groupBy(*KEY).agg(
        F.min(F.struct(*columns)).alias("first"), F.count("*").alias("copies")
    )
    return picked.select(*KEY, "first.*", "copies")


def link_tool_calls(
    calls: DataFrame, results: DataFrame, schemas: dict[str, Schema]
) -> DataFrame:
    """One row for each (conversation, identifier) that has calls or results.

    `calls`: conv_id, call_id, position, name, arguments (JSON), after (the identifier of the
    call whose result it uses, or null). `results`: conv_id, call_id, position, content.
    Of calls or results that share an identifier the first by position, then by content,
    counts, and `copies` says how many there were. Rows with a null conversation or identifier
    can't be linked and are left out. Columns: conv_id, call_id, level, position, status
    (linked, no_result, no_call, early_result), faults, copies, line (canonical JSON of the
    call and its result). Null arguments are faulty; null content is left out of the line; empty
    tables give no rows; other columns are not read.
    """
    one = _first_by_key(calls, ["position", "name", "arguments", "after"])
    other = _first_by_key(results, ["position", "content"]).select(
        *KEY,
        F.col("position").alias("result_position"),
        "content",
        F.col("copies").alias("result_copies"),
    )
    one = materialize(one, "tool-calls")
    levels = call_levels(one.select(*KEY, "after"))
    linked = one.withColumn("called", F.lit(True)).join(levels, KEY, "left").join(other, KEY, "full")
    faults = argument_faults(F.col("name"), F.col("arguments"), schemas)
    status = (
        F.when(F.col("called").isNull(), "no_call")
        .when(F.col("result_copies").isNull(), "no_result")
        .when(F.col("result_position") < F.col("position"), "early_result")
        .otherwise("linked")
    )
    line = F.to_json(
        F.struct(
            F.try_parse_json("arguments").alias("arguments"),
            F.col("call_id").alias("id"),
            "level",
            "name",
            F.col("content").alias("result"),
            F.col("status"),
        )
    )
    return (
        linked.withColumn("status", status)
        .withColumn("faults", F.when(F.col("called"), faults).otherwise(F.array().cast("array<string>")))
        .withColumn("line", line)
        .select(
            *KEY,
            "level",
            F.coalesce("position", "result_position").alias("position"),
            "status",
            "faults",
            (F.coalesce("copies", F.lit(0)) + F.coalesce("result_copies", F.lit(0))).alias("copies"),
            "line",
        )
    )


REPLY = {
    "reply": {
        "n_chars": Field("integer", minimum=1, maximum=2000),
        "prompt": Field("string", min_length=1),
        "tone": Field("string", required=False, choices=("short", "full")),
    }
}


def calls_of_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each user turn as a call that asks for a reply, each assistant turn as its result.

    The identifier of a call is its turn; a call uses the result of the user turn two before.
    A system turn is a call to a tool that has no schema.
    """
    named = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        whole_text("text").alias("text"),
    )
    identifier = F.concat(F.lit("call_"), F.col("turn"))
    arguments = F.to_json(
        F.struct(
            F.col("text").alias("prompt"),
            F.char_length("text").alias("n_chars"),
            F.when(F.col("turn") % 4 == 1, F.lit("short")).alias("tone"),
        )
    )
    calls = named.where("role IN ('user', 'system')").select(
        "conv_id",
        identifier.alias("call_id"),
        F.col("turn").alias("position"),
        F.when(F.col("role") == "user", "reply").otherwise("instruct").alias("name"),
        arguments.alias("arguments"),
        F.when(F.col("turn") >= 2, F.concat(F.lit("call_"), F.col("turn") - 2)).alias("after"),
    )
    results = named.where("role = 'assistant'").select(
        "conv_id",
        F.concat(F.lit("call_"), F.col("turn") - 1).alias("call_id"),
        F.col("turn").alias("position"),
        F.col("text").alias("content"),
    )
    return calls, results


def op9_tool_calls(spark, sf_dir):
    calls, results = calls_of_conversations(table(spark, sf_dir, "conversations"))
    linked = link_tool_calls(calls, results, REPLY)
    return linked.withColumn("faults", F.concat_ws("; ", "faults"))


SQL = """
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
called AS (
  SELECT conv_id, turn, CASE role WHEN 'user' THEN 'reply' ELSE 'instruct' END AS name, text,
         count(*) OVER (PARTITION BY conv_id, turn) AS copies,
         row_number() OVER (PARTITION BY conv_id, turn ORDER BY CASE role WHEN 'user' THEN 'reply' ELSE 'instruct' END, text) AS k
  FROM turns WHERE role IN ('user', 'system')),
calls AS (SELECT * FROM called WHERE k = 1),
levels AS (
  SELECT c.conv_id, c.turn, 0::BIGINT AS level FROM calls c LEFT JOIN calls p ON p.conv_id = c.conv_id AND p.turn = c.turn - 2
  WHERE p.turn IS NULL
  UNION ALL
  SELECT c.conv_id, c.turn, l.level + 1 FROM levels l JOIN calls c ON c.conv_id = l.conv_id AND c.turn = l.turn + 2),
answered AS (
  SELECT conv_id, turn, text, count(*) OVER (PARTITION BY conv_id, turn) AS copies,
         row_number() OVER (PARTITION BY conv_id, turn ORDER BY text) AS k
  FROM turns WHERE role = 'assistant'),
results AS (SELECT conv_id, turn - 1 AS turn, text, copies FROM answered WHERE k = 1),
both_ AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.turn) AS turn, l.level, c.name,
         coalesce(c.turn, r.turn + 1) AS position, c.text AS prompt, r.text AS result,
         coalesce(c.copies, 0) + coalesce(r.copies, 0) AS copies,
         CASE WHEN c.turn IS NULL THEN 'no_call' WHEN r.turn IS NULL THEN 'no_result' ELSE 'linked' END AS status
  FROM calls c LEFT JOIN levels l ON l.conv_id = c.conv_id AND l.turn = c.turn
  FULL JOIN results r ON r.conv_id = c.conv_id AND r.turn = c.turn)
SELECT conv_id, 'call_' || turn AS call_id, level, position, status, copies,
       CASE WHEN name IS NULL THEN '' WHEN name = 'instruct' THEN 'unknown tool' ELSE concat_ws('; ',
            CASE WHEN length(prompt) < 1 THEN 'n_chars: too small' WHEN length(prompt) > 2000 THEN 'n_chars: too large' END,
            CASE WHEN prompt = '' THEN 'prompt: too short' END) END AS faults,
       '{' || concat_ws(',',
            CASE WHEN name IS NOT NULL THEN '"arguments":{"n_chars":' || length(prompt) || ',"prompt":' || to_json(prompt)
                 || CASE WHEN turn % 4 = 1 THEN ',"tone":"short"' ELSE '' END || '}' END,
            '"id":"call_' || turn || '"',
            CASE WHEN level IS NOT NULL THEN '"level":' || level END,
            CASE WHEN name IS NOT NULL THEN '"name":"' || name || '"' END,
            CASE WHEN result IS NOT NULL THEN '"result":' || to_json(result) END,
            '"status":"' || status || '"') || '}' AS line
FROM both_
"""
