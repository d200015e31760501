"""URL filters by association rules.

Given rules (host, path, verdict) decide the urls they fit.  The decided urls
are the labels: each becomes a transaction of its URL tokens and its verdict,
Spark's FP-growth mines frequent combinations, and the association rules that
lead to a verdict are pruned by support and confidence, by the number of hosts,
and where a more general rule is as confident.  Rules made only of what the given
rules ask for would repeat these elsewhere, so they do not vote.  An inverted index from token to rule finds, for
every other url, the rules whose tokens it has; the most confident (then the
best supported, then allow before block) gives the verdict, and without
one the default does.

A url that is null or has no "://" has an empty host and path and no tokens.
Rules fit a host and its subdomains where the url's path starts with the
rule's; the longest (host and path together, then the longer host) wins.
Repeated rows are judged alike; an empty table gives no rows and mines nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations, islice

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import add_columns, narrow_batches, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARK = "verdict="
ITEMS_AT_ONCE = 12   # items of a transaction, of which FP-growth makes all combinations; does not change the rules


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str    # allow or block

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(url, r"^[\s\S]*?://([\s\S]*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null: one CASE over the list, longest first."""
    case = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        case = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(case)
    return case


_DIGITS = re.compile(r"\d+")
_KEYS = re.compile(r"[?&]([^=&#]+)")


def tokens_of(host: str | None, path: str | None, url: str | None) -> list[str]:
    """The tokens of a URL for mining: host suffixes, host labels, path segments, the last one's ending, query keys."""
    if not host:
        return []
    labels = [x for x in host.split(".") if x]
    found = [f"tld:{labels[-1]}"] if labels else []
    found += [f"label:{x}" for x in labels[:-1]]
    if len(labels) > 2:
        found.append(f"sub:{labels[0]}")
    found += [f"site:{'.'.join(labels[-3:])}"] if len(labels) > 1 else []
    segments = [s for s in (path or "").split("/") if s]
    if segments:
        stem, dot, ending = segments[-1].rpartition(".")
        if dot and stem:
            segments[-1] = stem
            found.append(f"ending:{ending.lower()}")
    found += [f"path{k}:{_DIGITS.sub('0', s.lower())}" for k, s in enumerate(segments)]
    query = (url or "").partition("#")[0].partition("?")[2]
    found += [f"key:{k.lower()}" for k in _KEYS.findall(f"?{query}")] if query else []
    return sorted(set(found))


@dataclass(frozen=True)
class Mined:
    """Pruned association rules and the inverted index from a token to the rules that need it."""

    rules: tuple[tuple[frozenset, str, float, float], ...]   # tokens, verdict, confidence, support; best first
    default: str = "allow"
    same: dict[str, str] = field(default_factory=dict)   # token -> the one that stands for it in the rules

    def index(self) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {}
        for i, (tokens, *_) in enumerate(self.rules):
            for t in tokens:
                out.setdefault(t, []).append(i)
        return out

    def fitting(self, tokens: list[str], index: dict[str, list[int]]) -> list[int]:
        met: dict[int, int] = {}
        for t in {self.same.get(t, t) for t in tokens}:
            for i in index.get(t, ()):
                met[i] = met.get(i, 0) + 1
        return [i for i, n in met.items() if n == len(self.rules[i][0])]

    def verdict(self, tokens: list[str], index: dict[str, list[int]]) -> str:
        whole = self.fitting(tokens, index)
        return self.rules[min(whole)][1] if whole else self.default


def seed_tokens(rules: list[Rule]) -> frozenset[str]:
    """The tokens on which given rules condition themselves."""
    return frozenset(t for r in rules for t in tokens_of(r.host, r.path, None))


def _subsets(items: list[str], bucket: dict[str, int], most: int) -> Iterator[tuple[str, list[str]]]:
    """(name, items) of every set of at most ``most`` buckets that ``items`` occupy."""
    by_bucket: dict[int, list[str]] = {}
    for t in items:
        by_bucket.setdefault(bucket[t], []).append(t)
    for size in range(1, min(most, len(by_bucket)) + 1):
        for chosen in combinations(sorted(by_bucket), size):
            yield ".".join(map(str, chosen)), [t for b in chosen for t in by_bucket[b]]


def _buckets(reduced: DataFrame, items: list[str], most: int) -> dict[str, int]:
    """Deal ``items`` (most frequent first) to the fewest buckets by doubling, so that no url has more than
    ``ITEMS_AT_ONCE`` items in any ``most`` of them; a bucket an item is the last resort."""
    n = 1
    while n < len(items):
        bucket = {t: k % n for k, t in enumerate(items)}

        def load(columns: list[pa.Array]) -> list[pa.Array]:
            counts = [Counter(bucket[t] for t in row) for row in columns[0].to_pylist()]
            return [pa.array([sum(sorted(c.values())[-most:]) for c in counts], pa.int32())]

        worst = add_columns(reduced.select("items"), ["items"], {"load": T.IntegerType()}, load).agg(F.max("load")).first()[0]
        if (worst or 0) <= ITEMS_AT_ONCE:
            return bucket
        n *= 2
    return {t: k for k, t in enumerate(items)}


def _undominated(rules: DataFrame) -> DataFrame:
    """Rules (tokens sorted, verdict, confidence, support) of which no part of the tokens says the same as surely."""
    parts = F.concat(F.transform("tokens", lambda t: F.array(t)), F.transform(
        F.sequence(F.lit(0), F.size("tokens") - 1), lambda i: F.filter("tokens", lambda t, j: j != i)))
    part = rules.select("tokens", "verdict", "confidence", F.explode(F.array_distinct(parts)).alias("part")).where(
        (F.size("part") > 0) & (F.size("part") < F.size("tokens")))
    known = rules.select(F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("of_part"))
    fallen = part.join(known, ["part", "verdict"]).where("of_part >= confidence").select("tokens", "verdict")
    return rules.join(fallen.distinct(), ["tokens", "verdict"], "left_anti")


def _hosts_of(labelled: DataFrame, mined: Mined) -> dict[int, int]:
    """Number of distinct sites on whose urls each rule holds with its verdict."""
    shared = labelled.sparkSession.sparkContext.broadcast(mined)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        index = model.index()
        for batch in batches:
            site, tokens, verdict = (c.to_pylist() for c in batch.columns)
            met = {(i, s) for s, ts, v in zip(site, tokens, verdict) for i in model.fitting(ts, index) if model.rules[i][1] == v}
            yield pa.RecordBatch.from_pydict({"rule": [m[0] for m in met], "site": [m[1] for m in met]}, pa.schema(
                [("rule", pa.int32()), ("site", pa.string())]))

    narrow_batches(labelled.sparkSession)
    met = labelled.select("site", "tokens", "verdict").distinct().mapInArrow(run, "rule int, site string")
    return {r["rule"]: r["n"] for r in met.groupBy("rule").agg(F.count_distinct("site").alias("n")).collect()}


def mine(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.8, default: str = "allow",
         max_tokens: int = 3, min_hosts: int = 1, seeds: frozenset[str] = frozenset()) -> Mined:
    """Rules of one to ``max_tokens`` (at most 3) tokens from ``labelled`` (tokens array<string>, verdict string; with
    ``min_hosts`` above 1 also site string).

    A rule has the given support and confidence, no part of its tokens says the same as surely, and it
    holds with its verdict on ``min_hosts`` distinct sites.  Rules of ``seeds`` alone (the tokens of the
    rules that made the labels) do not vote, but a rule must be surer than they are.

    Tokens below the support are in no rule, and tokens that are always met together are mined as one.
    FP-growth makes every combination of a transaction's items, so long urls are cut into
    several transactions: items are dealt to buckets, and a url gives one for each set of up to
    ``max_tokens`` buckets that it occupies.  A combination is read from the transactions of exactly its
    own buckets, which every url that has it gives once, so counts are exact and the rules the same for any
    number of buckets; urls of at most ``ITEMS_AT_ONCE`` items stay one transaction.  Only rules that
    are left after the pruning, which Spark does, reach the driver.
    """
    if not 1 <= max_tokens <= 3:
        raise ValueError("max_tokens must be 1, 2 or 3")
    n, verdicts = labelled.count(), {r[0] for r in labelled.select("verdict").distinct().collect()}  # allow, block
    if not n:
        return Mined((), default)
    least = max(1, math.ceil(min_support * n))
    one = F.explode("tokens").alias("token")
    # a sum of the hashes of the urls that have a token tells which tokens have the same ones
    counts = labelled.select(one, F.xxhash64("tokens", "verdict").cast("decimal(38,0)").alias("id")).groupBy(
        "token").agg(F.count("*").alias("n"), F.sum("id").alias("where")).where(F.col("n") >= least).collect()
    first: dict[tuple, str] = {}
    same = {r["token"]: first.setdefault((r["n"], r["where"], r["token"] in seeds), r["token"])
            for r in sorted(counts, key=lambda r: r["token"])}
    items = [r["token"] for r in sorted(counts, key=lambda r: (-r["n"], r["token"])) if same[r["token"]] == r["token"]]
    if not items:
        return Mined((), default)
    merged = labelled.sparkSession.sparkContext.broadcast(same)

    def reduce(columns: list[pa.Array]) -> list[pa.Array]:
        return [pa.array([sorted({merged.value[t] for t in row if t in merged.value}) for row in columns[0].to_pylist()],
                         pa.list_(pa.string()))]

    reduced = add_columns(labelled.select("tokens", "verdict"), ["tokens"], {"items": T.ArrayType(T.StringType())}, reduce)
    dealt = labelled.sparkSession.sparkContext.broadcast(_buckets(reduced, items, max_tokens))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # a long url's are never held at once
        made = ([f"{name}|{t}" for t in [*some, MARK + end]] for batch in batches
                for row, end in zip(*(c.to_pylist() for c in batch.columns))
                for name, some in _subsets(row, dealt.value, max_tokens))
        while rows := list(islice(made, 1000)):
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], names=["items"])

    transactions = stage(reduced.select("items", "verdict").mapInArrow(cut, "items array<string>"), "url-transactions")
    total = transactions.count()
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / total, minConfidence=min_confidence).fit(transactions)
    name, tokens = F.split_part(F.element_at("antecedent", 1), F.lit("|"), F.lit(1)), F.array_sort(F.transform(
        "antecedent", lambda t: F.substr(t, F.instr(t, "|") + 1)))
    rules = model.associationRules.where(F.size("antecedent") <= max_tokens).select(
        name.alias("name"), tokens.alias("tokens"), F.expr(f"substring(consequent[0], instr(consequent[0], '|') + {1 + len(MARK)})").alias("verdict"),
        F.element_at("consequent", 1).contains(f"|{MARK}").alias("ends"), "confidence", (F.col("support") * total / n).alias("support"))
    rules = rules.where(F.col("ends") & ~F.exists("tokens", lambda t: t.startswith(MARK)))

    def own(columns: list[pa.Array]) -> list[pa.Array]:  # the transactions of exactly its own buckets
        return [pa.array([n == ".".join(map(str, sorted({dealt.value[t] for t in row})))
                          for n, row in zip(*(c.to_pylist() for c in columns))], pa.bool_())]

    exact = stage(add_columns(rules, ["name", "tokens"], {"own": T.BooleanType()}, own).where("own").select(
        "tokens", "verdict", "confidence", F.round(F.col("support") * n).alias("times")), "url-rules")
    kept = _undominated(exact).where(F.size(F.array_except("tokens", F.array(*[F.lit(t) for t in sorted(seeds)]).cast(
        "array<string>"))) > 0).collect()
    # a tie between verdicts goes by their names
    ranked = sorted(((frozenset(r["tokens"]), r["verdict"], r["confidence"], r["times"] / n) for r in kept if r["verdict"] in verdicts),
                    key=lambda r: (-r[2], -r[3], r[1], sorted(r[0])))
    mined = Mined(tuple(ranked), default, same)
    if min_hosts > 1 and ranked:
        hosts = _hosts_of(labelled, mined)
        mined = Mined(tuple(r for i, r in enumerate(ranked) if hosts.get(i, 0) >= min_hosts), default, same)
    return mined


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", min_support: float = 0.002,
          min_confidence: float = 0.8, default: str = "allow", min_hosts: int = 1) -> DataFrame:
    """``pages`` with host, path, rule and verdict of each url (columns of these names are replaced), and
    ``mined``: whether the verdict is the method's.  Mined rules must hold on ``min_hosts`` registered hosts
    (the last two labels)."""
    names = ["host", "path", "rule", "verdict", "mined"]
    host, path = host_and_path(F.col(f"`{url}`"))
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in names]
    if not any(c.lower() == url.lower() for c in pages.columns if c.lower() not in names):
        raise ValueError(f"the url column may not have one of the names {names}")
    parts = pages.select(*kept, host.alias("host"), path.alias("path"))

    def tokens(columns: list[pa.Array]) -> list[pa.Array]:
        return [pa.array([tokens_of(h, p, u) for h, p, u in zip(*(c.to_pylist() for c in columns))],
                         pa.list_(pa.string()))]

    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    labels = add_columns(parts.select(F.col(f"`{url}`").alias("url"), "host", "path", fit.alias("fit")).where(
        "fit is not null"), ["host", "path", "url"], {"tokens": T.ArrayType(T.StringType())}, tokens)
    site = F.array_join(F.slice(F.split("host", r"\."), -2, 2), ".")
    site = F.when(F.size(F.split("host", r"\.")) > 2, site).otherwise(F.col("host"))
    mined = mine(stage(labels.select("tokens", F.col("fit.verdict").alias("verdict"), site.alias("site")), "url-labels"),
                 min_support, min_confidence, default, min_hosts=min_hosts, seeds=seed_tokens(rules))
    shared = pages.sparkSession.sparkContext.broadcast(mined)
    decided = parts.withColumn("__llm_fit", fit)
    at = {c: decided.columns.index(c) for c in ("host", "path", "__llm_fit")}
    url_at = next(i for i, c in enumerate(decided.columns) if c.lower() == url.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        index = model.index()
        for batch in batches:
            hosts, paths, urls, fits = (batch.column(i).to_pylist() for i in (
                at["host"], at["path"], url_at, at["__llm_fit"]))
            verdicts = [f["verdict"] if f else model.verdict(tokens_of(h, p, u), index)
                        for h, p, u, f in zip(hosts, paths, urls, fits)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([f["rule"] if f else None for f in fits], pa.string()),
                 pa.array(verdicts, pa.string()), pa.array([f is None for f in fits], pa.bool_())],
                names=[*batch.schema.names[:-1], "rule", "verdict", "mined"])

    narrow_batches(pages.sparkSession)
    schema = T.StructType([*parts.schema.fields, T.StructField("rule", T.StringType()),
                           T.StructField("verdict", T.StringType()), T.StructField("mined", T.BooleanType())])
    return decided.mapInArrow(run, schema)
