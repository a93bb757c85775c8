"""Chat formatting: raw records of different layouts become canonical turns, then one marked text with a loss mask.

A record is a JSON text.  The hash of its sorted nested field paths (``messages[].role`` ...) is its layout's
fingerprint; it selects a declarative mapping, which says where roles and texts are.  The template marks turns:

    user        <s>[INST]text[/INST]
    assistant   text</s>
    any other   <s>[ROLE=role]text[/ROLE]

Inside texts and roles each of ``\\ < [ ]`` gets a backslash before it, so no control string can occur in them, and
reading back is exact.  The loss mask covers the assistant texts.

Defined results
* null text: the empty text; null role: the empty role.  Rows of a conversation are ordered by turn, then role, text;
  repeated rows are turns of their own.  Rows with a null conversation id are one conversation with a null id.
* a record whose layout has no mapping, or that is no JSON, comes back with null turns; it is not dropped.
* extra columns are not read; empty tables give empty results.  A conversation is one record, whatever its length.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .common import materialize, scratch_column, text_or_empty


def field_paths(value: object, at: str = "$") -> set[str]:
    """The nested field paths of a JSON value; the items of an array share one path."""
    out, todo = set(), [(value, at)]
    while todo:
        value, at = todo.pop()
        if isinstance(value, dict) and value:
            todo += [(v, f"{at}.{k}") for k, v in value.items()]
        elif isinstance(value, list) and value:
            todo += [(v, f"{at}[]") for v in value]
        else:
            out.add(at)
    return out


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode("utf-8", "surrogatepass")).hexdigest()[:16]


# The declarative mappings: either ``turns`` (role, field) in order, or ``each`` (array, role field, text field), with
# the names that a layout uses for the canonical roles.
MAPPINGS = [
    {"turns": [("user", "prompt"), ("assistant", "response")]},
    {"turns": [("user", "instruction"), ("assistant", "output")]},
    {"turns": [("system", "system"), ("user", "instruction"), ("assistant", "output")]},
    {"each": ("messages", "role", "content")},
    {"each": ("conversations", "from", "value"), "roles": {"human": "user", "gpt": "assistant"}},
]


def mapping_paths(mapping: dict) -> set[str]:
    if "turns" in mapping:
        return {f"$.{field}" for _, field in mapping["turns"]}
    array, role, text = mapping["each"]
    return {f"$.{array}[].{role}", f"$.{array}[].{text}"}


def _said(value: object) -> str | None:
    """A text as it is, nothing as the empty text, a number or a truth value as JSON writes it; None for others."""
    if value is None or isinstance(value, str):
        return value or ""
    return json.dumps(value) if isinstance(value, (bool, int, float)) else None


def mapped_turns(record: dict, mapping: dict) -> list[tuple[str, str]] | None:
    """The (role, text) turns of a record, None where a part of the mapping is missing or is no text."""
    if "turns" in mapping:
        found = [(role, _said(record.get(field, {}))) for role, field in mapping["turns"]]
    else:
        array, role, text = mapping["each"]
        names, items = mapping.get("roles", {}), record.get(array)
        if not isinstance(items, list) or not all(isinstance(x, dict) for x in items):
            return None
        found = [(_said(x.get(role, {})), _said(x.get(text, {}))) for x in items]
        found = [(names.get(r, r), t) for r, t in found]
    return None if any(r is None or t is None for r, t in found) else found


def read_record(raw: str | None, known: dict[str, dict]) -> tuple[str, list[tuple[str, str]] | None]:
    """(layout, turns) of a record's JSON text; turns are None for any record that cannot be read."""
    try:
        record = json.loads(raw) if raw is not None else None
    except (ValueError, RecursionError):  # no JSON, or nested too deeply to be a record
        record = None
    layout = fingerprint(field_paths(record))
    mapping = known.get(layout)
    return layout, mapped_turns(record, mapping) if mapping and isinstance(record, dict) else None


_TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))


def canonical(records: DataFrame, raw_col: str = "raw", mappings: list[dict] | None = None) -> DataFrame:
    """The records with ``layout`` (their fingerprint) and ``turns`` (null without a mapping).

    Columns of these names that the records bring are replaced.
    """
    known = {fingerprint(mapping_paths(m)): m for m in (MAPPINGS if mappings is None else mappings)}

    @pandas_udf(T.StructType([T.StructField("layout", T.StringType()), T.StructField("turns", _TURNS)]))
    def read(raws: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in raws:
            found = [read_record(raw, known) for raw in part]
            yield pd.DataFrame({"layout": [x for x, _ in found],
                                "turns": [None if t is None else [{"role": r, "text": x} for r, x in t] for _, t in found]})

    own = scratch_column(records, "read")
    kept = [F.col(f"`{c}`") for c in records.columns if c.lower() not in ("layout", "turns")]
    rows = records.withColumn(own, read.asNondeterministic()(F.col(f"`{raw_col}`")))
    return rows.select(*kept, F.col(f"{own}.layout").alias("layout"), F.col(f"{own}.turns").alias("turns"))


def escape(text: Column) -> Column:
    for c in "\\<[]":
        text = F.replace(text, F.lit(c), F.lit(f"\\{c}"))
    return text


def formatted(turns: Column) -> Column:
    """The marked text of an array of (role, text)."""
    def turn(t: Column) -> Column:
        role, text = escape(text_or_empty(t["role"])), escape(text_or_empty(t["text"]))
        return (F.when(t["role"] == "assistant", F.concat(text, F.lit("</s>")))
                .when(t["role"] == "user", F.concat(F.lit("<s>[INST]"), text, F.lit("[/INST]")))
                .otherwise(F.concat(F.lit("<s>[ROLE="), role, F.lit("]"), text, F.lit("[/ROLE]"))))

    return F.array_join(F.transform(turns, turn), "")


_BODY = r"[^\\<\[\]]*+(?:\\.[^\\<\[\]]*+)*+"
_TURN = re.compile(rf"(?s)(?:<s>\[(?:INST|ROLE=(?P<role>{_BODY}))\])?(?P<text>{_BODY})(?P<end>\[/INST\]|\[/ROLE\]|</s>)")
_ESCAPED = re.compile(r"(?s)\\(.)")


def read_back(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start and end: where the escaped text is."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        role = {"[/INST]": "user", "</s>": "assistant"}.get(m["end"])
        if role is None:
            role = _ESCAPED.sub(r"\1", m["role"])
        out.append((role, _ESCAPED.sub(r"\1", m["text"]), m.start("text"), m.end("text")))
        at = m.end()
    return out


_DIGEST = T.StructType([T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
                        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
                        T.StructField("formatted_chars", T.LongType())])


@pandas_udf(_DIGEST)
def digest_udf(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """What a reader of the marked texts gets: turns, and the text under the loss mask."""
    def sha(parts: list[str]) -> str:
        return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()

    for part in texts:
        rows = []
        for text in part:
            turns = read_back(text)
            loss = [x for role, x, _, _ in turns if role == "assistant"]
            rows.append((len(turns), sha([f"{r}\n{x}\n" for r, x, _, _ in turns]), sum(map(len, loss)), sha(loss),
                         len(text)))
        yield pd.DataFrame(rows, columns=_DIGEST.names)


@pandas_udf(T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))
def loss_mask_udf(texts: pd.Series) -> pd.Series:
    """The loss mask of the marked texts: spans of code points."""
    return pd.Series([[{"start": s, "end": e} for r, _, s, e in read_back(t) if r == "assistant"] for t in texts])


def mixed_records(rows: DataFrame) -> DataFrame:
    """(conv_id, raw): a table of turns as JSON records in the layouts that its shapes allow, picked by the id."""
    turns = (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", text_or_empty("role").alias("role"), text_or_empty("text").alias("text")))).alias("turns")))
    roles = F.transform("turns", lambda t: t["role"])
    text = lambda i: F.get("turns", F.lit(i))["text"]
    pick = F.pmod(F.xxhash64("conv_id"), F.lit(3))
    pair = roles == F.array(F.lit("user"), F.lit("assistant"))
    triple = roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    plain = F.forall(roles, lambda r: r.isin("user", "assistant", "system"))
    other = F.transform("turns", lambda t: F.struct(
        F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"]).alias("from"),
        t["text"].alias("value")))
    raw = (F.when(pair & (pick == 0), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
           .when(pair & (pick == 1), F.to_json(F.struct(text(0).alias("instruction"), text(1).alias("output"))))
           .when(triple & (pick < 2), F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"),
                                                         text(2).alias("output"))))
           .when(plain & (pick == 2), F.to_json(F.struct(other.alias("conversations"))))
           .otherwise(F.to_json(F.struct(F.transform("turns", lambda t: F.struct(
               t["role"].alias("role"), t["text"].alias("content"))).alias("messages")))))
    return turns.select("conv_id", raw.alias("raw"))


def format_records(records: DataFrame) -> DataFrame:
    """(conv_id, layout, formatted): records of any known layout as marked texts."""
    return canonical(records).select("conv_id", "layout", formatted(F.col("turns")).alias("formatted"))


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the stored output."""
    stored = materialize(format_records(mixed_records(rows)))
    out = stored.withColumn("d", digest_udf("formatted"))
    return out.select("conv_id", *[F.col(f"d.{c}").alias(c) for c in _DIGEST.names])
