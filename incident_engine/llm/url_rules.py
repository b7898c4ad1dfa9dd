"""URL filters by a sort-merge range join of reversed hosts.

A host's labels in reverse order, each with a full stop behind it, are its key: all hosts below a
rule's host have keys that begin with the rule's key, so a rule is an interval of keys. Urls and
rules are dealt to ranges of keys, a rule to every range its interval meets, and each range is swept
in key order with a stack of the rules whose intervals are open: intervals are nested or apart, so
the stack is the chain of rules for the host at hand. Of those whose path begins the url's path the
longest wins; of equally long ones the one with the longer host, then block.

Cut points between ranges come from a sample of keys of fixed size and hold a hash of the row next to
the key, so that a host with a third of all rows is spread over many ranges; every row is swept.
Null urls and those without ``://`` have no host and path and follow no rule. The verdict without a
rule is ``default``. Rules with a null or without a host are left out; a table of rules may be large.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block")]
DEFAULT = "allow"
#: Rows of a range, and the most keys sampled for the cut points.
RANGE_ROWS, SAMPLED = 200_000, 20_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SWEPT = "page_id long, host string, path string, rule string, verdict string"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _cuts(urls: DataFrame) -> list[tuple[str, int]]:
    rows = urls.count()
    n = max(1, -(-rows // RANGE_ROWS), min(8, rows // 1000))
    wanted = min(SAMPLED, 64 * n)
    part = min(1.0, 1.5 * wanted / max(rows, 1))
    seen = sorted((r["key"], r["salt"]) for r in urls.filter(
        F.pmod(F.xxhash64("salt"), F.lit(1 << 20)) < int(part * (1 << 20)) + 1)
        .select("key", "salt").limit(4 * SAMPLED).collect()) if n > 1 else []
    return sorted({seen[i * len(seen) // n] for i in range(1, n)}) if seen else []


def sweep(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows (range, key, kind, id, host, path, rule, verdict) in order of range, key and kind;
    kind 0 opens a rule, kind 1 asks for an url."""
    stack: list[tuple[str, list[tuple]]] = []
    current = None
    for part, key, kind, id_, host, path, rule, verdict in rows:
        if part != current:
            current, stack = part, []
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        if kind == 0:
            if not stack or stack[-1][0] != key:
                stack.append((key, []))
            stack[-1][1].append((len(rule), len(key), verdict == "block", path, rule, verdict))
            continue
        best = max((r for _, rules in stack for r in rules if path.startswith(r[3])), default=None)
        yield id_, host, path, best and best[4], best and best[5]


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict per row. ``rules``: rule (host and path), verdict."""
    url = F.col("url")
    urls = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                        F.col(f"`{url_col}`").cast("string").alias("url"))
    urls = urls.select("id", host_of(url).alias("host"), path_of(url).alias("path"))
    urls = urls.select("*", key_of(F.col("host")).alias("key"),
                       F.xxhash64("id", "path").alias("salt"))
    cuts = urls.sparkSession.sparkContext.broadcast(_cuts(urls.filter("host != ''")))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [bisect_right(cuts.value, x) for x in zip(
                batch["key"].to_pylist(), batch["salt"].to_pylist(), strict=True)]
            yield batch.drop_columns(["salt"]).append_column("part", pa.array(parts, pa.int32()))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch["key"].to_pylist()
            parts = [list(range(bisect_right(cuts.value, (k, -(1 << 63))),
                                bisect_right(cuts.value, (k + "\U0010FFFF", 0)) + 1)) for k in keys]
            yield batch.append_column("parts", pa.array(parts, pa.list_(pa.int32())))

    asked = urls.mapInArrow(dealt, "id long, host string, path string, key string, part int") \
        .select("part", "key", F.lit(1).alias("kind"), "id", "host", "path",
                F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    known = rules.select(F.col("rule").cast("string").alias("rule"),
                         F.col("verdict").cast("string").alias("verdict")) \
        .filter("rule is not null and verdict is not null and rule like '_%/%'") \
        .withColumn("host", F.translate(F.substring_index("rule", "/", 1), _UPPER, _LOWER)) \
        .filter("host != ''").withColumn("path", F.expr("substr(rule, instr(rule, '/'))")) \
        .withColumn("key", key_of(F.col("host"))).dropDuplicates(["rule", "verdict"])
    opened = known.select("key", "path", "rule", "verdict").mapInArrow(
        spread, "key string, path string, rule string, verdict string, parts array<int>") \
        .select(F.explode("parts").alias("part"), "key", F.lit(0).alias("kind"),
                F.lit(None).cast("long").alias("id"), F.lit("").alias("host"), "path", "rule",
                "verdict")
    ordered = asked.filter("host != ''").union(opened).repartition(
        len(cuts.value) + 1, "part").sortWithinPartitions("part", "key", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        out: list[tuple] = []
        for row in sweep(rows()):
            out.append(row)
            if len(out) == 10_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    swept = ordered.mapInArrow(run, _SWEPT)
    none = urls.filter("host = ''").select(
        F.col("id").alias("page_id"), "host", "path", F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("verdict"))
    return swept.union(none).withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
        names=["page_id", "host", "path", "rule", "verdict"])
