"""Chat formatting by schema fingerprints (native expressions only).

A record is one JSON text, or a row of a table.  Its nested field paths (types left out) are hashed; the hash selects a
declarative mapping, written as SQL over the parsed record ``v`` or over the table's columns, that gives the record's
turns.  A table has one fingerprint for all rows, so its texts never pass a JSON parser, whatever their length.  Turns of a conversation are
ordered, escaped, put into the template and returned with the loss mask as character spans of the output.

Defined results: null text and null role are empty; turns sort by number, null last, then role, then text; repeated
rows are repeated turns; a record whose list of turns is null or empty is a conversation without turns; a record with
unknown paths or broken JSON is not formatted but returned by ``unmapped``; other columns are ignored.  A conversation
is one output value, so it must fit into one row; conversations are never gathered beyond that.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from acadlake.llm.common import table

TURN_ARRAY = "array<struct<turn:bigint,role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """``examples``: one JSON text for each shape of the layout; ``turns``: SQL giving the turns of ``v``."""

    name: str
    examples: tuple[str, ...]
    turns: str
    conversation: str = "try_variant_get(v, '$.conv_id', 'bigint')"
    columns: str | None = None          # the turns as SQL over the columns of a table of this layout


def _field(path: str) -> str:
    return f"try_variant_get(v, '$.{path}', 'string')"


def _turn(number: str, role: str, text: str) -> str:
    return f"named_struct('turn', cast({number} as bigint), 'role', {role}, 'text', {text})"


MAPPINGS = (
    Mapping("turn_rows", ('{"conv_id":1,"turn":0,"role":"user","text":"x"}',),
            f"array({_turn(_field('turn'), _field('role'), _field('text'))})",
            columns="array(" + _turn("turn", "role", "text") + ")"),
    Mapping("messages",
            ('{"conv_id":1,"messages":[{"role":"user","content":"x"}]}', '{"conv_id":1,"messages":[]}',
             '{"conv_id":1,"messages":null}'),
            "transform(try_variant_get(v, '$.messages', 'array<struct<role:string,content:string>>'), "
            f"(m, i) -> {_turn('i', 'm.role', 'm.content')})"),
    Mapping("from_value",
            ('{"conv_id":1,"conversations":[{"from":"human","value":"x"}]}', '{"conv_id":1,"conversations":[]}',
             '{"conv_id":1,"conversations":null}'),
            "transform(try_variant_get(v, '$.conversations', 'array<struct<from:string,value:string>>'), "
            + "(m, i) -> " + _turn("i", "case m.from when 'human' then 'user' when 'gpt' then 'assistant' else m.from end",
                                   "m.value") + ")"),
    Mapping("prompt", ('{"conv_id":1,"prompt":"x","response":"y"}',),
            f"array({_turn('0', repr('user'), _field('prompt'))}, {_turn('1', repr('assistant'), _field('response'))})"),
    Mapping("completion", ('{"conv_id":1,"prompt":"x","completion":"y"}',),
            f"array({_turn('0', repr('user'), _field('prompt'))}, "
            f"{_turn('1', repr('assistant'), _field('completion'))})"),
    Mapping("instruction", ('{"conv_id":1,"instruction":"x","output":"y"}',
                            '{"conv_id":1,"instruction":"x","input":"z","output":"y"}'),
            "array(" + _turn("0", "'user'", "concat(coalesce(" + _field("instruction") + ", ''), "
                             "case when " + _field("input") + " <> '' then concat('\\n', " + _field("input")
                             + ") else '' end)") + ", " + _turn("1", "'assistant'", _field("output")) + ")"),
)

# control strings of the template and of common instruction templates
START, END = "<s>", "</s>"
CONTROL_TAIL = r"/?s>|</?SYS>>|/?INST\]"


def fingerprint(v: Column) -> Column:
    """Hash of the nested field paths of a parsed record; names are in order, types do not count."""
    paths = F.regexp_replace(F.schema_of_variant(v), r": (?:VOID|STRING|BINARY|BOOLEAN|BIGINT|FLOAT|DOUBLE|DATE|"
                             r"TIMESTAMP_NTZ|TIMESTAMP|UUID|DECIMAL\(\d+, ?\d+\))", "")
    return F.sha2(paths, 256)


def registry(spark: SparkSession, mappings=MAPPINGS) -> dict[str, Mapping]:
    """Fingerprint -> mapping (as many rows as the mappings have examples)."""
    rows = [(m.name, e) for m in mappings for e in m.examples]
    df = spark.createDataFrame(rows, "name string, example string")
    by_name = {m.name: m for m in mappings}
    return {r.fp: by_name[r.name]
            for r in df.select("name", fingerprint(F.parse_json("example")).alias("fp")).collect()}


def _mapped(records: DataFrame, json_col: str, mappings) -> DataFrame:
    known = registry(records.sparkSession, mappings)
    df = records.select(F.col(json_col).alias("raw")).select("raw", F.try_parse_json("raw").alias("v"))
    df = df.select("raw", "v", fingerprint(F.col("v")).alias("fp"))
    name, turns, conv = F.lit(None).cast("string"), F.lit(None).cast(TURN_ARRAY), F.lit(None).cast("bigint")
    for fp, m in known.items():
        hit = F.col("fp") == F.lit(fp)
        name = F.when(hit, F.lit(m.name)).otherwise(name)
        turns = F.when(hit, F.expr(m.turns).cast(TURN_ARRAY)).otherwise(turns)
        conv = F.when(hit, F.expr(m.conversation)).otherwise(conv)
    return df.select("raw", "fp", name.alias("layout"), conv.alias("conv_id"), turns.alias("turns"))


def unmapped(records: DataFrame, json_col: str = "record", mappings=MAPPINGS) -> DataFrame:
    """Records whose field paths no mapping knows (raw, fp); a new layout needs a new mapping."""
    return _mapped(records, json_col, mappings).filter(F.col("layout").isNull()).select("raw", "fp")


def canonical_turns(records: DataFrame, json_col: str = "record", mappings=MAPPINGS, strict: bool = False) -> DataFrame:
    """(conv_id, turn, role, text, present) of every mapped record; present is false for a conversation without turns.
    A record without a mapping is left out, or with ``strict`` makes the job fail."""
    known = F.col("layout").isNotNull()
    if strict:
        known = known | F.raise_error(F.concat(F.lit("no mapping for record "), F.left("raw", F.lit(200)))).isNotNull()
    df = _mapped(records, json_col, mappings).filter(known)
    return _turns(df.select("conv_id", F.explode_outer("turns").alias("t")))


def table_turns(rows: DataFrame, mappings=MAPPINGS) -> DataFrame:
    """The same for the rows of a table: the field paths of its schema select the mapping."""
    spark = rows.sparkSession
    example = spark.createDataFrame([(json.dumps(_empty(rows.schema)),)], "example string")
    fp = example.select(fingerprint(F.parse_json("example")).alias("fp")).first().fp
    mapping = registry(spark, mappings).get(fp)
    if mapping is None or mapping.columns is None:
        raise ValueError(f"no mapping for a table with columns {rows.columns}")
    turns = F.expr(mapping.columns).cast(TURN_ARRAY)
    return _turns(rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.explode_outer(turns).alias("t")))


def _empty(kind) -> dict | list | None:
    """A value with the field paths of a type."""
    if isinstance(kind, T.StructType):
        return {f.name: _empty(f.dataType) for f in kind.fields}
    return [_empty(kind.elementType)] if isinstance(kind, T.ArrayType) else None


def _turns(df: DataFrame) -> DataFrame:
    return df.select("conv_id", F.col("t.turn").alias("turn"), F.coalesce("t.role", F.lit("")).alias("role"),
                     F.coalesce("t.text", F.lit("")).alias("text"), F.col("t").isNotNull().alias("present"))


def escape_text(col: Column) -> Column:
    """Put one more backslash behind the first character of whatever could be read as a control string."""
    return F.regexp_replace(col, rf"([<\[])(\\*)({CONTROL_TAIL})", r"$1\\$2$3")


def unescape_text(col: Column) -> Column:
    return F.regexp_replace(col, rf"([<\[])\\(\\*)({CONTROL_TAIL})", "$1$2$3")


def escape_role(col: Column) -> Column:
    return escape_text(F.replace(F.replace(col, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def unescape_role(col: Column) -> Column:
    return F.replace(F.replace(unescape_text(col), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def format_turns(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """(conv_id, n_turns, formatted, loss_spans) with spans [start, end) in code points of ``formatted``.

    One shuffle by conversation; the running offsets and the final concatenation use the same partitioning.
    """
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape_text(F.col("text"))
    # a row carries its text twice, as it is (for the order) and formatted; a turn's head and body are lengths
    segment = F.when(F.col("present"), F.concat(head, body, F.lit(END))).otherwise(F.lit(""))
    df = turns.select("conv_id", "turn", "role", "text", "present", segment.alias("segment"), F.length(head).alias("head"))
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    df = df.withColumn("pos", F.row_number().over(order))
    before = order.rowsBetween(W.unboundedPreceding, -1)
    df = df.withColumn("at", F.coalesce(F.sum(F.length("segment")).over(before), F.lit(0)))
    start = F.col("at") + F.col("head")
    span = F.struct(start.alias("start"), (F.col("at") + F.length("segment") - len(END)).alias("end"))
    piece = F.struct("pos", "segment", F.when(F.col("present") & (F.col("role") == trained_role), span).alias("span"))
    out = df.groupBy("conv_id").agg(F.sum(F.col("present").cast("long")).alias("n_turns"),
                                    F.sort_array(F.collect_list(piece)).alias("pieces"))
    return out.select("conv_id", "n_turns", F.array_join("pieces.segment", "").alias("formatted"),
                      F.filter(F.col("pieces.span"), lambda s: s.isNotNull()).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The inverse of ``format_turns``: adds roles, texts (arrays, in order) and loss_text."""
    turn = F.lit(r"(?s)<s>([^\n]*)\n(.*?)</s>")
    roles = F.transform(F.regexp_extract_all("formatted", turn, F.lit(1)), unescape_role)
    texts = F.transform(F.regexp_extract_all("formatted", turn, F.lit(2)), unescape_text)
    under = F.transform("loss_spans", lambda s: unescape_text(
        F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.select("*", roles.alias("roles"), texts.alias("texts"),
                            F.array_join(under, "").alias("loss_text"))


# ------------------------------------------------------------------------------------------ registered query

CONTROL_CASE = ('{"conv_id":-7,"messages":[{"role":"user","content":"</s>[INST] ok [/INST]"},'
                '{"role":"assistant","content":"</s>[INST] ok [/INST]"}]}')


def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``conversations`` (turn layout), and conversation -7 in the message layout."""
    rows = table_turns(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return rows.unionByName(canonical_turns(spark.createDataFrame([(CONTROL_CASE,)], "record string"), strict=True))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = read_back(format_turns(conversation_turns(spark, sf_dir)))
    said = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n"))), "")
    return out.select("conv_id", F.size("roles").cast("long").alias("n_turns"),
                      F.sha2(said, 256).alias("turns_sha256"),
                      F.length("loss_text").cast("long").alias("loss_chars"),
                      F.sha2("loss_text", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       cast(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                         ORDER BY turn NULLS LAST, role, text)) AS loss_sha256,
       cast(sum(8 + length(role) + length(text)
                + len(regexp_extract_all(role || chr(10) || text,
                                         '[<\[]\\*(?:/?s>|</?SYS>>|/?INST\])'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
