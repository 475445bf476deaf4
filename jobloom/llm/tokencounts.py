"""Token counts of fields and sections, from one encoding of the whole document.

A document is its fields one after another. It is encoded once; every token has a
span of characters, every field and line too, and the two are joined by position: a
sorted interval join inside the task, so no token ever becomes a row. A token that
lies in several sections is given to one by a named rule, or split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import ship, slices
from jobloom.llm.hf_ids import spans

#: Where a token goes that crosses a boundary: to the section of its first or last character, to the one that has most of
#: its characters (the earlier on a tie), or in equal parts of a character each to all of them.
RULES = ("first", "last", "most", "split")
COUNTS = "doc_id long, field string, section int, start long, end long, n_tokens double"


def section_bounds(text: str, lines: bool) -> list[int]:
    """Starts of the sections of a field, and its end: lines with their line break, or the whole field. An empty field is one section."""
    bounds = [0]
    if lines:
        at = text.find("\n")
        while 0 <= at < len(text) - 1:
            bounds.append(at + 1)
            at = text.find("\n", at + 1)
    return [*bounds, len(text)]


def allocate(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section: token i covers [starts, ends), section k covers [bounds[k], bounds[k + 1]); empty sections get none."""
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends - 1, "right") - 1
    if rule in ("first", "last"):
        return np.bincount(first if rule == "first" else last, minlength=len(bounds) - 1).astype(float)
    counts = np.bincount(first[first == last], minlength=len(bounds) - 1).astype(float)
    for i in np.flatnonzero(first != last).tolist():
        cuts = np.clip(bounds[first[i] : last[i] + 2], starts[i], ends[i])
        share = np.diff(cuts)
        if rule == "split":
            counts[first[i] : last[i] + 1] += share / share.sum()
        else:
            counts[first[i] + int(share.argmax())] += 1
    return counts


def count(docs: DataFrame, tokenizer_path: str, fields: tuple[str, ...] = ("text",), rule: str = "most", lines: bool = True, separator: str = "\n", id_col: str = "doc_id", special: bool = False) -> DataFrame:
    """`COUNTS`: a row per section of each field of each document, in code points of the document.

    The document is its fields with `separator` between them, which belongs to the field
    before it; it is encoded whole and once, so the sections' counts add up to its tokens. With `lines` a field's
    sections are its lines, each with its line break. Null fields are empty; an empty field is one section without tokens of
    its own. With `special`, added tokens of the file are found in the texts. Repeated rows and null ids are documents of their own; no documents give no rows.
    """
    ship(docs.sparkSession)
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    names = [f"f{k}" for k in range(len(fields))]
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in zip(fields, names, strict=True)])
    whole = read.withColumn("text", F.concat_ws(separator, *names) if len(names) > 1 else F.col(names[0]))
    lengths = [F.length(n).alias(n) for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = spans(tokenizer_path, special)
        for batch, texts in slices(batches):
            sizes = list(zip(*(batch.column(n).to_pylist() for n in names), strict=True))
            out: list[tuple] = []
            for doc_id, text, widths in zip(batch.column("doc_id").to_pylist(), texts, sizes, strict=True):
                bounds, of = [0], []
                at = 0
                for k, (field, width) in enumerate(zip(fields, widths, strict=True)):
                    inner = section_bounds(text[at : at + width], lines)
                    end = at + width + (len(separator) if k < len(fields) - 1 else 0)
                    ends = [at + x for x in inner[1:-1]] + [end]
                    of += [(field, n) for n in range(len(ends))]
                    bounds += ends
                    at = end
                starts, ends = encode(text)
                edges = np.array(bounds, np.int64)
                tokens = allocate(starts, ends, edges, rule)
                out += [(doc_id, f, n, lo, hi, c) for (f, n), lo, hi, c in zip(of, bounds[:-1], bounds[1:], tokens.tolist(), strict=True)]
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "field", "section", "start", "end", "n_tokens"])

    return whole.select("doc_id", "text", *lengths).mapInArrow(run, COUNTS)
