"""Secret scans, with DataFrame functions only.

Base patterns find assignments, access keys and hexadecimal strings. Beyond
them, candidate strings of a character class are scanned with a sliding window
whose Shannon entropy is kept by incremental counts: a character enters, one
leaves, and sum(c * log2 c) changes by their four terms. Windows above the class
threshold make a span, unless the candidate fits the allow-list.

Positions count code points from 0, ends are exclusive. They come from the
lengths of the pieces between matches (``split``) and of the matches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickrisk.llm.common import table

# base patterns (fixed values)
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_SIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""    # in every assignment
# a match takes its whole run, so asking for the least length at once drops the same ones
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
LEAST = {"assign": 12, "access": 18, "hex": 16}

SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"
PLACED = "array<struct<start:int,found:string,value:string>>"


@dataclass
class EntropyClass:
    """Maximal runs of ``alphabet`` (a regex class body and its characters) of at least
    ``window`` characters; bits per character from ``threshold`` on are suspicious."""

    kind: str
    pattern: str
    alphabet: str
    window: int
    threshold: float


# a word in one case, capitalised or joined as in camelCase; no letters in random case
WORD = "(?:[A-Z]?[a-z]+(?:[A-Z][a-z]{2,})*|[A-Z]{1,20})"
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"


@dataclass
class ScanRules:
    classes: list[EntropyClass] = field(default_factory=lambda: [
        EntropyClass("hex_entropy", "0-9a-fA-F", DIGITS + "abcdefABCDEF", 24, 3.0),
        EntropyClass("base64_entropy", "A-Za-z0-9+/_-", UPPER + LOWER + DIGITS + "+/_-", 24, 4.0)])
    # candidates that fit one of these as a whole are no secrets: words, words joined by
    # signs, numbers, paths of lower-case names, UUIDs
    allow: list[str] = field(default_factory=lambda: [
        r"^[A-Z]?[a-z]+$", f"^{WORD}(?:[_/+-]{WORD})*$", r"^[0-9_/+-]+$", r"^/?([a-z0-9_-]+/)+[a-z0-9_-]*$",
        r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"])


def _placed(df: DataFrame, out: str, pattern: str, guard: Column, group: int, least: int) -> DataFrame:
    """Adds ``out``: the matches of ``pattern`` in ``_t``, in order, as (start, found, value)
    whose value, the match's ``group``, has at least ``least`` characters. ``guard`` is a
    cheap test that holds for every text with a match."""
    none = F.array().cast("array<string>")
    df = (df.withColumn("_f", F.when(guard, F.regexp_extract_all("_t", F.lit(pattern), F.lit(0))).otherwise(none))
          .withColumn("_some", F.size("_f") > 0)
          .withColumn("_g", F.when(F.col("_some"), F.split("_t", pattern, -1)).otherwise(none))
          .withColumn("_v", F.when(F.col("_some"), F.regexp_extract_all("_t", F.lit(pattern), F.lit(group)))
                      .otherwise(none)))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(PLACED).alias("out"))

    def step(a, x):
        begin = a["at"] + F.length(x["_g"])
        more = F.concat(a["out"], F.array(F.struct(begin.alias("start"), x["_f"].alias("found"), x["_v"].alias("value"))))
        return F.struct((begin + F.length(x["_f"])).alias("at"),
                        F.when(F.length(x["_v"]) >= least, more).otherwise(a["out"]).alias("out"))

    # split gives one more piece than there are matches: the text after the last
    return (df.withColumn("_z", F.slice(F.arrays_zip("_f", "_g", "_v"), 1, F.greatest(F.size("_f"), F.lit(0))))
            .withColumn(out, F.aggregate("_z", zero, step, lambda a: a["out"]))
            .drop("_f", "_some", "_g", "_v", "_z"))


def _span(start: Column, rank: int, kind: str, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(rank).alias("rank"),
                    F.lit(kind).alias("kind"), end.cast("int").alias("end"))


def _base_kind(df: DataFrame, out: str, rank: int, pattern: str, guard: Column, group: int = 0) -> DataFrame:
    df = _placed(df, "_p", pattern, guard, group, LEAST[out])
    return df.withColumn(out, F.transform("_p", lambda x: _span(
        x["start"], rank, out, x["start"] + F.length(x["found"])))).drop("_p")


def _dense(found: Column, c: EntropyClass) -> Column:
    """(from, to) of the windows of ``found`` whose entropy reaches the threshold: from the
    first one's start to the last one's end, or from -1.

    ``n`` counts the characters in the window, ``h`` is sum(n * log2 n); a window of W
    characters has entropy log2 W - h / W."""
    w = c.window
    codes = F.transform(F.split(found, ""), lambda ch: F.instr(F.lit(c.alphabet), ch) - 1)
    weight = F.array(*[F.lit(k * math.log2(k) if k else 0.0) for k in range(w + 2)])
    most = w * (math.log2(w) - c.threshold) + 1e-9
    zero = F.struct(F.array_repeat(F.lit(0), len(c.alphabet)).alias("n"), F.lit(0.0).alias("h"),
                    F.lit(0).alias("i"), F.lit(-1).alias("from"), F.lit(-1).alias("to"))

    def let(value: Column, body) -> Column:
        return F.transform(F.array(value), body)[0]

    def step(a, x):
        enters, leaves, i = x["enters"], x["leaves"], a["i"]
        had = a["n"][enters]
        # the leaving character's count, once the entering one is in
        left = F.when(leaves >= 0, a["n"][F.greatest(leaves, F.lit(0))] + (leaves == enters).cast("int")).otherwise(0)
        h = (a["h"] + weight[had + 1] - weight[had]
             + F.when(leaves >= 0, weight[F.greatest(left - 1, F.lit(0))] - weight[left]).otherwise(0.0))
        n = F.transform(a["n"], lambda k, j: k + (j == enters).cast("int") - (j == leaves).cast("int"))

        def moved(h):
            dense = (i >= w - 1) & (h <= most)
            return F.struct(n.alias("n"), h.alias("h"), (i + 1).alias("i"),
                            F.when(dense & (a["from"] < 0), i - (w - 1)).otherwise(a["from"]).alias("from"),
                            F.when(dense, i + 1).otherwise(a["to"]).alias("to"))
        return let(h, moved)

    def scan(codes):
        moves = F.transform(codes, lambda e, i: F.struct(
            e.alias("enters"), F.when(i >= w, codes[F.greatest(i - w, F.lit(0))]).otherwise(-1).alias("leaves")))
        return F.aggregate(moves, zero, step, lambda a: F.struct(a["from"].alias("from"), a["to"].alias("to")))

    return let(codes, scan)


def _entropy_kind(df: DataFrame, rank: int, c: EntropyClass, allow: list[str], earlier: list[str]) -> DataFrame:
    """Adds column ``c.kind``: spans of this class that no span of ``earlier`` columns touches."""
    run = f"(?<![{c.pattern}])[{c.pattern}]{{{c.window},}}"
    df = _placed(df, "_p", run, F.col("_t").rlike(run), 0, c.window)

    def allowed(x):
        out = F.lit(False)
        for pattern in allow:
            out = out | x["found"].rlike(pattern)
        return out

    df = (df.withColumn("_p", F.filter("_p", lambda x: ~allowed(x)))
          .withColumn("_p", F.transform("_p", lambda x: F.struct(x["start"].alias("start"),
                                                                 _dense(x["found"], c).alias("w"))))
          .withColumn("_p", F.filter("_p", lambda x: x["w"]["from"] >= 0))
          .withColumn("_p", F.transform("_p", lambda x: _span(x["start"] + x["w"]["from"], rank, c.kind,
                                                              x["start"] + x["w"]["to"])))
          .withColumn("_e", F.concat(*earlier)))
    return df.withColumn(c.kind, F.when(F.size("_p") > 0, F.filter("_p", lambda x: ~F.exists(
        "_e", lambda e: (e["start"] < x["end"]) & (x["start"] < e["end"])))).otherwise(F.col("_p"))).drop("_p", "_e")


def find_spans(docs: DataFrame, text_col: str = "text", rules: ScanRules | None = None,
               out: str = "secret_spans") -> DataFrame:
    """Adds ``out``: all spans in order, as (start, rank, kind, end), to every row.

    A null or empty text has none. Rows are scanned one by one, with no exchange, so
    repeated rows and hot sources cost no more than others. Columns whose names begin
    with ``_`` are used on the way; ``docs`` must have none of these.
    """
    rules = rules or ScanRules()
    df = docs.withColumn("_t", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    df = _base_kind(df, "assign", 0, ASSIGN, F.col("_t").rlike(ASSIGN_SIGN), group=2)
    df = _base_kind(df, "access", 1, ACCESS, F.contains("_t", F.lit("AKIA")))
    df = _base_kind(df, "hex", 2, HEX, F.col("_t").rlike("[0-9a-f]{16}"))
    kinds = ["assign", "access", "hex"]
    for rank, c in enumerate(rules.classes, 3):
        df = _entropy_kind(df, rank, c, rules.allow, list(kinds))
        kinds.append(c.kind)
    return (df.withColumn(out, F.array_sort(F.concat(*kinds)).cast(SPANS)).drop("_t", *kinds))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           rules: ScanRules | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy of every row."""
    found = find_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", rules)
    of = lambda kind: F.filter("secret_spans", lambda x: x["kind"] == kind)
    base = F.filter("secret_spans", lambda x: x["rank"] < 3)
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("secret_spans")).alias("spans"),
        F.size(F.filter("secret_spans", lambda x: x["rank"] >= 3)).cast("long").alias("n_entropy"))


def redact(docs: DataFrame, mark: str = "[secret]", text_col: str = "text",
           rules: ScanRules | None = None) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans share one mark.
    A null text stays null."""
    columns = docs.columns
    # docs' own columns travel under other names, so they cannot clash with the helpers'
    df = docs.select(*[F.col(f"`{c}`").alias(f"in{i}") for i, c in enumerate(columns)])
    text = f"in{columns.index(text_col)}"
    df = find_spans(df, text, rules)
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(a, x):
        t = F.col(text)
        ahead = x["start"] >= a["at"]
        return F.struct(
            F.when(ahead, F.concat(a["out"], F.substr(t, a["at"] + 1, x["start"] - a["at"]), F.lit(mark)))
            .otherwise(a["out"]).alias("out"),
            F.greatest(a["at"], x["end"]).alias("at"))

    clean = F.aggregate("secret_spans", zero, step, lambda a: F.concat(
        a["out"], F.substr(F.col(text), a["at"] + 1, F.length(F.col(text)))))
    df = df.withColumn(text, F.when(F.size("secret_spans") > 0, clean).otherwise(F.col(text)))
    return df.select(*[F.col(f"in{i}").alias(c) for i, c in enumerate(columns)])


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` scanned."""
    return report(table(spark, sf_dir, "documents"))
