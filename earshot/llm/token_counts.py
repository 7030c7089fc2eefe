"""Token counts of whole texts by a map-side two-tier lookup.

A sentencepiece BPE model merges neighbouring symbols only where the result is a
vocabulary piece. Where no piece holds two neighbouring characters, no merge ever
crosses between them, and a text may be cut there without changing a token. For the
models served here that is so before every run of blanks and around every line
feed; ``CutCounter`` proves it on the vocabulary when it loads the file.

Tier one is a table of the lengths of frequent pre-tokens of the whole corpus, shipped
to all tasks. Tier two is a cache in each Python worker, bounded by characters and filled
by encoding what tier one misses. Neither changes a count. Only the few names that are
frequent within a task leave it; the pre-tokens themselves are never shuffled.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLANK = "▁"
#: With a blank before the text, every pre-token begins with blanks or a line feed.
_RUNS = re.compile("\n[^▁\n]*|▁+[^▁\n]*")


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a non-empty text, named without their first blank.

    A name that begins with a line feed stands for itself, any other for a blank
    followed by the name.
    """
    text = text.replace(BLANK, " ")
    parts = text.replace("\n", " \n").split(" ")
    if "" not in parts:
        return parts
    runs = _RUNS.findall(BLANK + text.replace(" ", BLANK))
    return [run if run[0] == "\n" else run[1:].replace(BLANK, " ") for run in runs]


class CutCounter(dict):
    """pre-token -> number of tokens, encoding what it does not know yet.

    What was encoded is kept up to ``keep`` characters, an entry counting for 64 more.
    """

    def __init__(self, path: str, frequent: dict[str, int], keep: int = 32 << 20):
        import sentencepiece

        super().__init__(frequent)
        self.frequent, self.keep, self.held = frequent, keep, 0
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.cut = can_be_cut(path)

    def __missing__(self, name: str) -> int:
        if name == "":
            n = 1
        else:
            n = len(self.model.encode(name)) - (name[0] == "\n")  # less the blank put before a text
        self.held += len(name) + 64
        if self.held > self.keep:
            self.clear()
            self.update(self.frequent)
            self.held = len(name) + 64
        if self.held <= self.keep:
            self[name] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.cut:
            return len(self.model.encode(text))
        return sum(map(self.__getitem__, pre_tokens(text)))


def can_be_cut(path: str) -> bool:
    """Whether no merge of this model crosses the borders of ``pre_tokens``."""
    from sentencepiece import sentencepiece_model_pb2 as spec

    model = spec.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    kinds = spec.ModelProto.SentencePiece
    words = [p.piece for p in model.pieces if p.type in (kinds.NORMAL, kinds.USER_DEFINED)]
    norm = model.normalizer_spec
    return (
        model.trainer_spec.model_type == spec.TrainerSpec.BPE
        and norm.name == "identity" and not norm.precompiled_charsmap and not norm.remove_extra_whitespaces
        and norm.add_dummy_prefix and not model.trainer_spec.treat_whitespace_as_suffix
        and not any(p.type == kinds.USER_DEFINED for p in model.pieces)
        and BLANK in words
        and not any(BLANK in w.lstrip(BLANK) or "\n" in w for w in words)
        and any(p.piece == "<0x0A>" and p.type == kinds.BYTE for p in model.pieces)
    )


def frequent_lengths(
    docs: DataFrame, path: str, text: str = "text", entries: int = 50_000, longest: int = 64
) -> dict[str, int]:
    """Lengths of the ``entries`` commonest pre-tokens of all texts: tier one.

    Each task counts its whole texts in a table of at most eight times ``entries`` names,
    the rarest half of which goes when it is full, and hands on the names that make up
    one in ``entries`` of its pre-tokens; a name with that share of the corpus has it in
    some task. Names over ``longest`` characters, of which bytes would fill the table, and
    names met once in a task are left to the workers' caches.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        total = 0
        for batch in batches:
            for value in batch["text"]:
                names = pre_tokens(value)
                total += len(names)
                seen.update(names)
                if len(seen) > 8 * entries:
                    seen = Counter(dict(c for c in seen.most_common(4 * entries) if len(c[0]) <= longest))
        rows = [(k, n) for k, n in seen.items() if n > 1 and n * entries >= total and len(k) <= longest]
        yield pd.DataFrame(rows, columns=["name", "n"])

    full = docs.select(F.col(text).alias("text")).where(F.length("text") > 0)
    counts = full.mapInPandas(run, "name string, n long").groupBy("name").agg(F.sum("n").alias("n"))
    rows = counts.orderBy(F.desc("n"), "name").limit(entries).collect()  # short names
    counter = CutCounter(path, {})
    return {r["name"]: counter[r["name"]] for r in rows}


def token_counts(
    docs: DataFrame, path: str, limit: int = 4096, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    Null text counts as empty, an empty text has no bytes and no tokens; null ids,
    repeated rows and very long texts are kept as they are; other columns are ignored;
    an empty table gives no rows.
    """
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text))

    @F.pandas_udf("bigint")
    def n_tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = CutCounter(path, frequent.value)
        for batch in texts:
            yield pd.Series([counter.count(t) for t in batch], dtype="int64")

    full = F.coalesce(F.col(text), F.lit(""))
    counted = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.octet_length(full).cast("long").alias("n_bytes"),
        n_tokens(full).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
