"""URL filters: host and path rules, then logistic regression on character n-grams.

The regression sees hashed 3- to 5-grams of host and path (with their ends marked,
hashed apart). It is trained on a small labelled URL table on the driver; scoring
runs where the URLs are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickrisk.llm.common import mix64, rows, table

# rule -> verdict of the registered query (fixed values)
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
GRAMS, BITS = (3, 4, 5), 18

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, ASCII letters lower-cased; else empty."""
    part = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(part, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule that fits (equally long ones in text order), or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def gram_features(hosts: list[bytes], paths: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every n-gram, duplicates included; hosts and paths are hashed apart."""
    found_rows, found = [], []
    for salt, parts in ((1, hosts), (2, paths)):
        marked = [b"\x02" + p + b"\x03" for p in parts]
        size = np.array([len(p) for p in marked], np.int64)
        data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
        row = np.repeat(np.arange(len(parts)), size)
        end = np.cumsum(size)[row] if len(row) else row
        for n in GRAMS:
            starts = np.flatnonzero(np.arange(len(data)) + n <= end)
            with np.errstate(over="ignore"):
                h = np.full(len(starts), salt * 16 + n, np.uint64)
                for k in range(n):
                    h = h * np.uint64(0x100000001B3) + data[starts + k] + np.uint64(1)
                found.append((mix64(h) >> np.uint64(64 - BITS)).astype(np.int64))
            found_rows.append(row[starts])
    return np.concatenate(found_rows), np.concatenate(found)


class UrlModel:
    """Weights of hashed n-grams; a URL's margin is the mean weight times sqrt(count), plus bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def probability(self, hosts: list[bytes], paths: list[bytes]) -> np.ndarray:
        row, feature = gram_features(hosts, paths)
        n = np.maximum(np.bincount(row, minlength=len(hosts)), 1)
        margin = np.bincount(row, self.weights[feature], len(hosts)) / np.sqrt(n) + self.bias
        return 1.0 / (1.0 + np.exp(-margin))


def fit_urls(hosts: list[bytes], paths: list[bytes], y: np.ndarray, rounds: int = 60, rate: float = 0.5,
             ridge: float = 1e-4) -> UrlModel:
    """Full-batch gradient descent with per-weight step sizes (Adagrad); y is 1 for block."""
    row, feature = gram_features(hosts, paths)
    scale = 1.0 / np.sqrt(np.maximum(np.bincount(row, minlength=len(hosts)), 1))
    weights, bias = np.zeros(1 << BITS), 0.0
    seen, seen_bias = np.full(1 << BITS, 1e-8), 1e-8
    for _ in range(rounds):
        margin = np.bincount(row, weights[feature], len(hosts)) * scale + bias
        error = (1.0 / (1.0 + np.exp(-margin)) - y) / len(y)
        grad = np.bincount(feature, (error * scale)[row], 1 << BITS) + ridge * weights
        seen += grad * grad
        weights -= rate * grad / np.sqrt(seen)
        g = error.sum()
        seen_bias += g * g
        bias -= rate * g / np.sqrt(seen_bias)
    return UrlModel(weights, bias)


def train_urls(labelled: DataFrame, sample: int = 20_000, url_col: str = "url",
               label_col: str = "blocked") -> UrlModel | None:
    """Model from at most ``sample`` distinct labelled URLs (those with the smallest hash).
    Null URLs and labels are left out; a URL labelled both ways counts as blocked. None if
    only one class is labelled."""
    chosen = (labelled.where(F.col(url_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(url_col).alias("u")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
              .orderBy(F.xxhash64("u"), "u").limit(sample)
              .select(host_of(F.col("u")).alias("h"), path_of(F.col("u")).alias("p"), "y").toArrow())
    y = np.array(chosen.column("y").to_pylist(), float)
    if len(np.unique(y)) < 2:
        return None
    return fit_urls(*([x.encode() for x in chosen.column(c).to_pylist()] for c in ("h", "p")), y)


def filter_urls(pages: DataFrame, rules: dict[str, str], model: UrlModel | None, id_col: str = "page_id",
                url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row.

    A rule's verdict stands; other URLs are blocked from P(block) = ``threshold`` on.
    A null URL, or one without ://, has empty host and path and no rule, and is judged
    by the model like any other; without a model what no rule blocks is allowed.
    Repeated rows give repeated results; other columns are ignored."""
    url = F.col(url_col).cast("string")
    parts = (pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"),
                          path_of(url).alias("path"))
             .withColumn("rule", rule_of(F.col("host"), F.col("path"), list(rules))))
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()),
                        ("rule", pa.string()), ("verdict", pa.string()), ("score", pa.float64())])

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                hosts, paths, rule = (part.column(c).to_pylist() for c in ("host", "path", "rule"))
                score = (model.probability([h.encode() for h in hosts], [p.encode() for p in paths])
                         if model is not None else np.zeros(len(hosts)))
                verdict = [rules[r] if r is not None else "block" if s >= threshold else "allow"
                           for r, s in zip(rule, score)]
                yield rows(schema, part.column("page_id"), hosts, paths, rule, verdict, score)

    return parts.mapInArrow(work, "page_id long, host string, path string, rule string, verdict string, score double")


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every URL of ``pages``; the labelled URLs are those that a rule decides."""
    pages = table(spark, sf_dir, "pages")
    decided = (pages.select("url", rule_of(host_of(F.col("url")), path_of(F.col("url")), list(RULES)).alias("rule"))
               .where("rule is not null"))
    labelled = decided.select("url", F.col("rule").isin([r for r, v in RULES.items() if v == "block"]).alias("blocked"))
    return filter_urls(pages, RULES, train_urls(labelled))
