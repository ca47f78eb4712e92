"""Tool calls and their results: linked by identifier, ordered by what they depend on, validated, written as JSON.

Every call and every result is one event, and one row of the result; so is every plain turn, if they are given; a conversation is its events in order, never
one value, so a conversation with a third of all events is no burden to any task.

* **Linking.** Results are reduced to one per identifier (the earliest, then the smallest content), then calls find
  theirs by a hash join. Rows of one identifier are spread by a hash of the row over as many salts as all rows would fill with
  ``ROWS_PER_SALT``, and the other side is copied to those that it has rows in. Null identifiers go round the joins.
* **Order.** A call may come ``after`` another call, whose result it uses. Its level is the length of that chain, found by
  pointer doubling: each round every call looks as far back as all rounds before together. Events in the
  order of (conversation, level, call before result, turn, identifier) come after all they depend on.
* **Validation.** Arguments are parsed as JSON; the schema of the tool says which there are, of which type, and which
  are required.
* **Plain turns** (system messages, unknown and null roles) are linked with nothing: level 0, status ``plain``.
* **JSON** is canonical: keys in code point order, no white space, no nulls; one object per event.

Defined results: a call without a result is ``unanswered``; a result without a call is an ``orphan``; further results of
one identifier are ``repeated``. A call after a call that does not exist starts at level 0 and is
``dangling``; calls that wait for each other have no level and are ``cyclic``. Null identifiers link with nothing.
Arguments that are no JSON object are reported as ``malformed`` and written as text. Repeated calls are each linked
with the one result. Empty tables give no events. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehist.llm.common import checkpointed

#: Rows of one identifier that are joined in one place, more or less.
ROWS_PER_SALT = 4096


@dataclass(frozen=True)
class Field:
    """An argument: its type (``string``, ``integer``, ``number``, ``boolean``, ``object``, ``array``) and bounds."""

    type: str
    required: bool = True
    least: float | None = None
    most: float | None = None


Schema = Mapping[str, Field]
#: How the types of JSON values read in Spark.
_TYPES = {
    "string": ["STRING"],
    "integer": ["BIGINT"],
    "number": ["BIGINT", "DOUBLE", "DECIMAL"],
    "boolean": ["BOOLEAN"],
    "object": ["OBJECT"],
    "array": ["ARRAY"],
}


def problems(name: Column, arguments: Column, schemas: Mapping[str, Schema]) -> Column:
    """What is wrong with a call, as an array of texts in order; ``arguments`` is a variant."""
    found = F.when(~F.startswith(F.schema_of_variant(arguments), F.lit("OBJECT")), F.array(F.lit("malformed")))
    for tool, schema in schemas.items():
        wrong = []
        for key, field in sorted(schema.items()):
            value = F.try_variant_get(arguments, f"$['{key}']", "variant")
            kind = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
            bad_type = ~kind.isin(_TYPES[field.type])
            absent = F.when(value.isNull() | (kind == "VOID"), F.lit(f"missing {key}" if field.required else None).cast("string"))
            check = absent.when(bad_type, F.lit(f"type of {key}"))
            number = F.try_variant_get(arguments, f"$['{key}']", "double")
            if field.least is not None:
                check = check.when(number < field.least, F.lit(f"{key} too small"))
            if field.most is not None:
                check = check.when(number > field.most, F.lit(f"{key} too large"))
            wrong.append(check)
        keys = F.coalesce(F.json_object_keys(F.to_json(arguments)), F.array().cast("array<string>"))
        extra = F.transform(F.array_except(keys, F.array(*[F.lit(k) for k in schema]).cast("array<string>")), lambda k: F.concat(F.lit("unknown "), k))
        listed = F.array_sort(F.concat(F.array_compact(F.array(*wrong).cast("array<string>")), extra))
        found = found.when(name == tool, listed)
    return F.when(arguments.isNull(), F.array(F.lit("malformed"))).otherwise(
        found.otherwise(F.array(F.lit("unknown tool")))
    )


def _salts(*tables: DataFrame) -> int:
    return max(1, -(-sum(t.count() for t in tables) // ROWS_PER_SALT))


def _salted(rows: DataFrame, lookup: DataFrame, key: str, salts: int, how: str = "left") -> DataFrame:
    """``rows`` with the columns of ``lookup``, which has one row per ``key``; no key is a burden to one task.

    The lookup is copied to the salts that a key has rows in, and to no other.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(F.struct(*rows.columns)), F.lit(salts)))
    copies = salted.select(key, "_salt").distinct().join(lookup, key)
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def levels(calls: DataFrame, salts: int | None = None) -> DataFrame:
    """``call_id, level, dangling``, one row per identifier; of repeated identifiers the smallest ``after`` counts."""
    salts = salts or _salts(calls)
    known = calls.where("call_id IS NOT NULL").groupBy("call_id").agg(F.min("after").alias("after"))
    there = known.select(F.col("call_id").alias("after"), F.lit(True).alias("there"))
    found = F.col("there").isNotNull()
    # Calls after none are where a chain begins, a third of all of them perhaps; there is nothing to join them with.
    first = known.where("after IS NULL").select(
        "call_id", F.lit(None).cast(dict(known.dtypes)["call_id"]).alias("back"), F.lit(0).cast("long").alias("level"), F.lit(False).alias("dangling")
    )
    state = _salted(known.where("after IS NOT NULL"), there, "after", salts).select(
        "call_id",
        F.when(found, F.col("after")).alias("back"),
        F.when(found, 1).otherwise(0).cast("long").alias("level"),
        (~found).alias("dangling"),
    ).unionByName(first)
    state = checkpointed(state)
    # No chain is longer than all calls together; what has not arrived by then waits for itself.
    for _ in range(state.count().bit_length()):
        if state.where("back IS NOT NULL").isEmpty():
            break
        # Those that have arrived need no join, and there are ever more of them.
        going, done = state.where("back IS NOT NULL"), state.where("back IS NULL")
        ahead = state.select(F.col("call_id").alias("back"), F.col("back").alias("next"), F.col("level").alias("more"), F.col("dangling").alias("lost"))
        moved = _salted(going, ahead, "back", salts, "inner").select(
            "call_id", F.col("next").alias("back"), (F.col("level") + F.col("more")).alias("level"), "dangling"
        )
        state = checkpointed(moved.unionByName(done))
    return state.select("call_id", F.when(F.col("back").isNull(), F.col("level")).alias("level"), "dangling")


def linked(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Schema], plain: DataFrame | None = None) -> DataFrame:
    """Events of ``calls`` (``conv_id, turn, call_id, name, arguments, after``, all but the first two text) and
    ``results`` (``conv_id, turn, call_id, content``), and of ``plain`` turns (``conv_id, turn, role, content``) if given.

    ``conv_id, level, kind, turn, call_id, name, status, problems, json``; ``kind`` is 0 for calls, 1 for results and
    2 for plain turns.
    """
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", "after")
    results = results.select("conv_id", "turn", "call_id", "content")
    chosen = results.where("call_id IS NOT NULL").groupBy("call_id").agg(
        F.min(F.struct("turn", F.xxhash64("content").alias("content"))).alias("answer")
    )
    salts = _salts(calls, results)
    placed = checkpointed(levels(calls, salts))
    ordered = _salted(calls, placed, "call_id", salts)
    answered = _salted(ordered, chosen.select("call_id", F.lit(True).alias("answered")), "call_id", salts)
    arguments = F.try_parse_json("arguments")
    wrong = problems(F.col("name"), F.col("parsed"), schemas)
    status = (
        F.when(F.col("level").isNull() & F.col("call_id").isNotNull(), "cyclic")
        .when(F.col("dangling"), "dangling")
        .when(F.col("answered").isNull(), "unanswered")
        .otherwise("linked")
    )
    body = answered.withColumn("parsed", arguments).withColumn("problems", wrong)
    is_object = ~F.array_contains("problems", "malformed")
    call_json = F.when(
        is_object, F.to_json(F.struct(F.col("parsed").alias("arguments"), F.col("call_id").alias("id"), "name", F.lit("call").alias("role"), "turn"))
    ).otherwise(F.to_json(F.struct("arguments", F.col("call_id").alias("id"), "name", F.lit("call").alias("role"), "turn")))
    call_events = body.select(
        "conv_id",
        F.when(F.col("call_id").isNull(), F.lit(0)).otherwise(F.col("level")).cast("long").alias("level"),
        F.lit(0).alias("kind"),
        "turn",
        "call_id",
        "name",
        status.alias("status"),
        "problems",
        call_json.alias("json"),
    )
    met = _salted(_salted(results, placed, "call_id", salts), chosen, "call_id", salts)
    first = (F.col("answer.turn").eqNullSafe(F.col("turn"))) & (F.col("answer.content") == F.xxhash64("content"))
    known = F.col("dangling").isNotNull()
    result_events = met.select(
        "conv_id",
        F.when(known, F.col("level")).otherwise(F.lit(0)).cast("long").alias("level"),
        F.lit(1).alias("kind"),
        "turn",
        "call_id",
        F.lit(None).cast("string").alias("name"),
        F.when(~known, "orphan").when(first, "linked").otherwise("repeated").alias("status"),
        F.array().cast("array<string>").alias("problems"),
        F.to_json(F.struct("content", F.col("call_id").alias("id"), F.lit("result").alias("role"), "turn")).alias("json"),
    )
    found = call_events.unionByName(result_events)
    if plain is not None:
        found = found.unionByName(_plain_events(plain))
    return found.orderBy("conv_id", "level", "kind", "turn", "call_id", "json")


def _plain_events(plain: DataFrame) -> DataFrame:
    return plain.select(
        "conv_id",
        F.lit(0).cast("long").alias("level"),
        F.lit(2).alias("kind"),
        "turn",
        F.lit(None).cast("string").alias("call_id"),
        F.lit(None).cast("string").alias("name"),
        F.lit("plain").alias("status"),
        F.array().cast("array<string>").alias("problems"),
        F.to_json(F.struct("content", "role", "turn")).alias("json"),
    )


#: Tools that turns of a conversation are read as calls of, see :func:`calls_of`.
SCHEMAS: dict[str, Schema] = {
    "search": {"query": Field("string"), "limit": Field("integer", least=1, most=3)},
    "summarise": {"text": Field("string"), "words": Field("integer", least=1), "style": Field("string", required=False)},
}


def calls_of(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results in plain conversations: a user's turn calls a tool with its text, and the assistant's next
    turn is the result. A short question is a search whose limit is the number of its sentences, any other a summary; a call
    comes after the one two turns before it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    sentences = F.regexp_count(text, F.lit(r"\."))

    def identifier(turn: Column) -> Column:
        return F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), turn.cast("string"))

    asked = turns.where("role = 'user'")
    short = words < 24
    calls = asked.select(
        F.col("conv_id"),
        F.col("turn"),
        identifier(F.col("turn")).alias("call_id"),
        F.when(short, "search").otherwise("summarise").alias("name"),
        F.when(short, F.to_json(F.struct(text.alias("query"), sentences.alias("limit"))))
        .otherwise(F.to_json(F.struct(words.alias("words"), text.alias("text"))))
        .alias("arguments"),
        F.when(F.col("turn") >= 2, identifier(F.col("turn") - 2)).alias("after"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id", "turn", identifier(F.col("turn") - 1).alias("call_id"), text.alias("content")
    )
    return calls, results


def plain_of(turns: DataFrame) -> DataFrame:
    """The turns that :func:`calls_of` leaves: those of any role but user and assistant, and of none."""
    return turns.where("role IS NULL OR role NOT IN ('user', 'assistant')").select(
        "conv_id", "turn", "role", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("content")
    )
