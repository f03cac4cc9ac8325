"""Mix sources of documents to target shares of the tokens, with a capped number of repeats.

Temperature mixing: the weight of a source lies on the path from its target share t (exponent 0) to its natural share p of all
tokens (exponent 1), t^(1-a) p^a. For each source the exponent is bisected to the least at which its repetition limit doesn't
bind, so a source that can reach its target keeps it. What the others fall short of goes to those that can give more, in
proportion to their targets: all targets are scaled by one factor, bisected until the weights sum to 1 (or nobody can give more),
the exponents following it. Without targets the weights are p^a, the exponent bisected until they have a wanted entropy.

Weights become token budgets, and a budget is realised as whole passes over the source's documents plus a part of one more
pass, taken in an order permuted by blocks: the documents of a source are hashed into blocks, whole blocks are taken while the
budget lasts, and only the one block in which it runs out is cut between documents.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.session import bounded_rows

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this tokenizer cuts a text before it merges bytes.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(f"file:{path}", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def with_tokens(df: DataFrame, text: str, keep: Sequence[str], path: str = TOKENIZER, pattern: str = PATTERN, name: str = "n_tokens") -> DataFrame:
    """Columns ``keep`` and the number of tokens of each whole text; NULL has 0. Strings of special tokens are ordinary text."""
    kept = df.select(*keep, F.col(text).alias("__text"))
    schema = T.StructType([*kept.schema.fields[:-1], T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(path, pattern).encode_ordinary
        for batch in batches:
            counts = pa.array([0 if t is None else len(encode(t)) for t in batch.column(len(keep)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], counts], names=[*keep, name])

    return kept.mapInArrow(run, schema)


def same_source(c: Column) -> Column:
    """One spelling for a source: lower case, no outer blanks, ``_`` for each of ``_``, ``-`` or blanks inside."""
    return F.regexp_replace(F.trim(F.lower(c)), r"[_\-\s]+", "_")


def weights(natural: Sequence[float], exponent: float) -> list[float]:
    """Normalised natural^a; a source without tokens has no weight."""
    raw = [n**exponent if n > 0 else 0.0 for n in natural]
    total = sum(raw)
    return [r / total if total > 0 else 0.0 for r in raw]


def entropy(shares: Sequence[float]) -> float:
    return -sum(s * math.log(s) for s in shares if s > 0)


def bisect(good, lo: float, hi: float, steps: int = 60) -> float:
    """The least number in [lo, hi] for which ``good`` holds, if it holds from somewhere on; hi where it never does."""
    if good(lo):
        return lo
    for _ in range(steps):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if good(mid) else (mid, hi)
    return hi


def on_path(target: float, natural: float, exponent: float) -> float:
    """target^(1-a) natural^a."""
    if exponent == 0 or target <= 0:
        return max(target, 0.0)
    return target ** (1 - exponent) * natural**exponent if natural > 0 else 0.0


def exponent_for_limit(target: float, tokens: int, limit: int, total: int) -> float:
    """The least exponent at which a source of that many tokens needs no more than ``limit`` passes for its part of ``total``."""
    natural = tokens / total if total else 0.0
    return bisect(lambda a: on_path(target, natural, a) * total <= limit * tokens, 0.0, 1.0)


def tempered(targets: Sequence[float], tokens: Sequence[int], limits: Sequence[int], total: int) -> tuple[list[float], list[float]]:
    """(exponents, shares of ``total``) of all sources at the factor of the targets at which the shares sum to 1, or at most."""
    most = [limit * n / total if total and t > 0 else 0.0 for t, n, limit in zip(targets, tokens, limits, strict=True)]

    def at(factor: float) -> tuple[list[float], list[float]]:
        exponents = [exponent_for_limit(factor * t, n, limit, total) for t, n, limit in zip(targets, tokens, limits, strict=True)]
        return exponents, [min(on_path(factor * t, n / total if total else 0.0, a), m) for t, n, a, m in zip(targets, tokens, exponents, most, strict=True)]

    if sum(at(1.0)[1]) >= 1 - 1e-12 and sum(targets) <= 1 + 1e-12:
        return at(1.0)
    top = 1.0
    while top < 2.0**60 and sum(at(top)[1]) < min(1.0, sum(most)) * (1 - 1e-12):
        top *= 2
    return at(bisect(lambda c: sum(at(c)[1]) >= min(1.0, sum(most)) * (1 - 1e-12), 0.0, top, 80))


def exponent_for_entropy(tokens: Sequence[int], wanted: float) -> float:
    """The exponent a in [0, 1] at which the shares p^a have the wanted entropy (less entropy for more a)."""
    everything = sum(tokens)
    natural = [n / everything if everything else 0.0 for n in tokens]
    return bisect(lambda a: entropy(weights(natural, a)) <= wanted, 0.0, 1.0)


PLAN = T.StructType([
    *[T.StructField(c, T.StringType()) for c in ("source", "written")], T.StructField("target_share", T.DoubleType()), T.StructField("max_repeats", T.LongType()),
    *[T.StructField(c, T.LongType()) for c in ("tokens", "all_tokens")], T.StructField("binds", T.BooleanType()),
    *[T.StructField(c, T.DoubleType()) for c in ("exponent", "tempered_share", "entropy_exponent", "entropy_share")], *[T.StructField(c, T.LongType()) for c in ("budget", "passes", "rest")],
])
KINDS = ("limit", "target", "entropy")


def plan(counted: DataFrame, targets: DataFrame, source: str = "source", kind: str = "limit") -> DataFrame:
    """One row for each row of ``targets`` (source, target_share, max_repeats): what its source has and shall give.

    ``counted`` has a source and n_tokens for each document. ``tokens`` are the source's, ``all_tokens`` those of all
    documents, also of sources without a target or with NULL; the mix is to have as many. ``binds``: the exponent that the
    source's limit asks for at its own target is above 0, so the target can't be reached. ``exponent`` and ``tempered_share``
    are those of the mix. ``budget`` is the token budget: by ``kind`` that of the tempered share (``limit``), of the target
    without giving shortfalls to others (``target``), or of the share with the entropy of the targets (``entropy``), each
    within the repetition limit. NULL target_share counts as 0, NULL or negative max_repeats as 0. The bisection runs over the rows of ``targets`` (a
    dimension, one row for each source) in one task; documents reach it only as sums.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}")
    spelled = counted.select(same_source(F.col(source)).alias("source"), "n_tokens")
    sums = spelled.rollup("source").agg(F.grouping("source").alias("whole"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"))
    wanted = targets.select(same_source(F.col("source")).alias("source"), F.col("source").alias("written"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)).cast("bigint").alias("max_repeats"))
    # One pass over the counts: each target meets the sum of its source and, under a key of its own, the sum of all.
    both = F.array(F.struct(F.col("source").alias("has"), F.lit(0).cast("tinyint").alias("whole")), F.struct(F.lit("").alias("has"), F.lit(1).cast("tinyint").alias("whole")))
    keyed = wanted.withColumn("__p", F.explode(both)).select("source", "written", "target_share", "max_repeats", "__p.has", "__p.whole")
    meets = keyed.join(sums.select(F.when(F.col("whole") == 1, "").otherwise(F.col("source")).alias("has"), "whole", "tokens"), ["has", "whole"], "left")
    own = F.sum(F.when(F.col("whole") == 0, F.col("tokens")))
    rows = meets.groupBy("source", "written", "target_share", "max_repeats").agg(F.coalesce(own, F.lit(0)).alias("tokens"), F.coalesce(F.max(F.when(F.col("whole") == 1, F.col("tokens"))), F.lit(0)).alias("all_tokens"))

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some = [f for f in frames if len(f)]
        if not some:
            return
        d = pd.concat(some, ignore_index=True)
        d = d.sort_values(["source", "written"], ignore_index=True)
        t, n, r = d.target_share.tolist(), d.tokens.tolist(), d.max_repeats.tolist()
        total = int(d.all_tokens.iloc[0])
        d["binds"] = [exponent_for_limit(share, x, limit, total) > 0 for share, x, limit in zip(t, n, r, strict=True)]
        d["exponent"], shares = tempered(t, n, r, total)
        d["tempered_share"] = [s / sum(shares) if sum(shares) else 0.0 for s in shares]
        b = exponent_for_entropy(n, entropy(t))
        natural = [x / sum(n) if sum(n) else 0.0 for x in n]
        d["entropy_exponent"], d["entropy_share"] = b, weights(natural, b)
        want = {"limit": shares, "target": t, "entropy": d.entropy_share.tolist()}[kind]
        d["budget"] = [min(int(w * total), limit * x) for w, limit, x in zip(want, r, n, strict=True)]
        d["passes"] = [b // x if x else 0 for b, x in zip(d.budget.tolist(), n, strict=True)]
        d["rest"] = [b - p * x for b, p, x in zip(d.budget.tolist(), d.passes.tolist(), n, strict=True)]
        yield d[[f.name for f in PLAN]]

    return rows.coalesce(1).mapInPandas(solve, PLAN)


def realise(counted: DataFrame, planned: DataFrame, doc_id: str = "doc_id", source: str = "source", seed: int = 1, blocks: int = 1 << 12) -> DataFrame:
    """The chosen documents (doc_id, source, n_tokens, repeats), repeats >= 1, of a plan.

    Every document of a source is taken ``passes`` times; one more time those that come first in the permutation while the
    rest of the budget lasts, so a source falls short of its budget by less than the tokens of one document. Rows with a NULL
    doc_id or a source without budget aren't chosen. Documents without tokens are taken with their block. ``blocks`` bounds the
    share of a source that is ever sorted: one block of it. The plan is read first; it has a row for each target, of which
    there may be 100,000, and what it says of the blocks is broadcast while that is at most 2^20 rows.
    """
    rows = bounded_rows(planned.select("source", "passes", "rest"), 100_000, "the plan of the mix")
    small = len(rows) * blocks <= 1 << 20
    budgets = F.broadcast(planned.sparkSession.createDataFrame(rows, "source string, passes bigint, rest bigint"))
    docs = counted.filter(F.col(doc_id).isNotNull()).select(doc_id, same_source(F.col(source)).alias("source"), "n_tokens", F.xxhash64(F.col(doc_id), F.lit(seed)).alias("__order"))
    docs = docs.withColumn("__block", F.pmod(F.col("__order"), F.lit(blocks)))
    totals = docs.groupBy("source", "__block").agg(F.sum("n_tokens").alias("__in_block")).join(budgets, "source")
    up_to = Window.partitionBy("source").orderBy("__block").rowsBetween(Window.unboundedPreceding, 0)
    totals = totals.withColumn("__end", F.sum("__in_block").over(up_to)).withColumn("__begin", F.col("__end") - F.col("__in_block"))
    marked = totals.filter("passes > 0 or __begin <= rest").select("source", "__block", "passes", (F.col("__end") <= F.col("rest")).alias("__whole"), ((F.col("__begin") <= F.col("rest")) & (F.col("__end") > F.col("rest"))).alias("__cut"), (F.col("rest") - F.col("__begin")).alias("__left"))
    chosen = docs.join(F.broadcast(marked) if small else marked, ["source", "__block"])
    plain = chosen.filter("not __cut").select(doc_id, "source", "n_tokens", (F.col("passes") + F.col("__whole").cast("int")).alias("repeats"))
    line = Window.partitionBy("source").orderBy("__order", doc_id).rowsBetween(Window.unboundedPreceding, 0)
    part = chosen.filter("__cut").withColumn("__upto", F.sum("n_tokens").over(line)).select(doc_id, "source", "n_tokens", (F.col("passes") + (F.col("__upto") <= F.col("__left")).cast("int")).alias("repeats"))
    return plain.unionByName(part).filter("repeats > 0")
