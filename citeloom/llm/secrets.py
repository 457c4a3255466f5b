"""Secret scans: patterns, and sliding-window entropy over candidate strings."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the three base kinds, in the order in which kinds are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12

# Candidate strings: runs of these characters of at least a window's length.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
# Least entropy in bits of a window, by the character class of the candidate.
CLASSES = {"hex": (r"^[0-9A-Fa-f]+$", 3.0), "alnum": (r"^[0-9A-Za-z]+$", 3.7), "mixed": (r"^.+$", 3.8)}
# Candidates that are no secrets: without both a letter and a digit, UUIDs, paths of words, placeholders.
ALLOWED = (
    r"^[A-Za-z+/_=-]*$",
    r"^[0-9+/_=-]*$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[a-z]+([-_/][a-z0-9]{1,12})+$",
    r"(?i)(example|placeholder|dummy|changeme|your[_-]?(key|token|secret))",
)
MILLIONTHS = 1_000_000
# c * log2(c) in millionths of a bit: whole numbers, so running sums are exact.
TERMS = [0, *[round(c * math.log2(c) * MILLIONTHS) for c in range(1, WINDOW + 1)]]


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def placed(lengths: Column) -> Column:
    """Elements (gap, size, part), one or more, as (start, end, part) by running sums of gaps and sizes.

    An array grows by copying, so no array grows by more than a block of about the root of their number: blocks
    are summed first, then each block is numbered from what the blocks before it hold.
    """
    none = F.array().cast("array<struct<start:int,end:int,part:string>>")

    def numbered(block: Column, offset: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            end = start + x["size"]
            one = F.struct(start.alias("start"), end.alias("end"), x["part"].alias("part"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        begin = F.struct(offset.alias("at"), none.alias("out"))
        return F.aggregate(block, begin, step, lambda acc: acc["out"])

    def joined(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda n, x: n + x["gap"] + x["size"]))
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        offsets = F.aggregate(
            sums,
            begin,
            lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"],
        )
        return F.flatten(F.zip_with(blocks, offsets, numbered))

    def dealt(listed: Column, size: Column) -> Column:
        first = F.sequence(F.lit(1), F.size(listed), size)
        return F.transform(first, lambda i: F.slice(listed, i, size))

    return once(
        lengths,
        lambda listed: once(F.ceil(F.sqrt(F.size(listed))).cast("int"), lambda size: once(dealt(listed, size), joined)),
    )


def places(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, part), in code points, end exclusive.

    What lies between the matches is the text split by the pattern, so a match begins after the
    lengths of all gaps and matches before it. Texts without a match are left after one search.
    """
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    lengths = F.zip_with(
        F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"))),
        parts,
        lambda x, p: F.struct(x["gap"].alias("gap"), x["size"].alias("size"), p.alias("part")),
    )
    # the last gap has no match
    lengths = F.filter(lengths, lambda x: x["size"].isNotNull())
    none = F.array().cast("array<struct<start:int,end:int,part:string>>")
    return F.when(text.rlike(pattern), placed(lengths)).otherwise(none)


def entropy_spans(text: Column, least: Column) -> Column:
    """First and last high window of a candidate: struct (first, last), null where no window is high.

    One pass: the window's character counts and the sum of c*log2(c) over them change by the
    character that enters and the one that leaves. A window is high when its entropy,
    log2(w) - sum / w, is at least ``least``.
    """
    terms = F.array(*[F.lit(t).cast("long") for t in TERMS])
    most = ((F.lit(math.log2(WINDOW)) - least) * WINDOW * MILLIONTHS).cast("long")
    codes = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    # each character with the one that leaves the window for it
    leaving = F.concat(F.array_repeat(F.lit(-1), WINDOW), codes)
    moves = F.filter(
        F.zip_with(codes, leaving, lambda new, old: F.struct(new.alias("new"), old.alias("old"))),
        lambda m: m["new"] >= 0,
    )

    def moved(counts: Column, code: Column, by: int) -> Column:
        return F.transform(counts, lambda n, i: F.when(i == code, n + by).otherwise(n))

    def step(acc: Column, m: Column) -> Column:
        new, old, counts, n = m["new"], m["old"], acc["counts"], acc["n"] + 1
        n_old = F.when(old >= 0, F.get(counts, old)).otherwise(F.lit(1))
        n_new = F.get(counts, new) - (old == new).cast("int")
        total = acc["sum"] - F.get(terms, n_old) + F.get(terms, n_old - 1) - F.get(terms, n_new) + F.get(terms, n_new + 1)
        without = F.when(old >= 0, moved(counts, old, -1)).otherwise(counts)
        high = (n >= WINDOW) & (total <= most)
        return F.struct(
            n.alias("n"),
            moved(without, new, 1).alias("counts"),
            total.alias("sum"),
            F.when(high & acc["first"].isNull(), n - WINDOW).otherwise(acc["first"]).alias("first"),
            F.when(high, n).otherwise(acc["last"]).alias("last"),
        )

    zero = F.struct(
        F.lit(0).alias("n"),
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
        F.lit(0).cast("long").alias("sum"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )
    return F.aggregate(
        moves,
        zero,
        step,
        lambda acc: F.when(acc["first"].isNotNull(), F.struct(acc["first"].alias("first"), acc["last"].alias("last"))),
    )


def high_entropy(text: Column) -> Column:
    """Spans (start, end) of candidates, cut to their high windows; allow-listed ones are left out."""

    def judged(c: Column) -> Column:
        least = F.lit(None).cast("double")
        for pattern, bits in reversed(CLASSES.values()):
            least = F.when(c["part"].rlike(pattern), F.lit(bits)).otherwise(least)
        found = entropy_spans(c["part"], least)
        return F.struct((c["start"] + found["first"]).alias("start"), (c["start"] + found["last"]).alias("end"))

    def suspect(c: Column) -> Column:
        allowed = c["part"].rlike(ALLOWED[0])
        for pattern in ALLOWED[1:]:
            allowed = allowed | c["part"].rlike(pattern)
        return ~allowed

    candidates = F.filter(places(text, CANDIDATE), suspect)
    return F.filter(F.transform(candidates, judged), lambda s: s["start"].isNotNull())


KINDS = ("assign", "access", "hex", "entropy")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, and for each kind an array of (start, end) in code points.

    ``assign`` (a named value of 12 characters or more), ``access`` (access key ids) and ``hex``
    (runs of 16 or more) come from patterns, leftmost and non-overlapping per kind; ``entropy``
    adds stretches of other strings whose windows have high Shannon entropy for their character
    class, unless the string is on the allow-list.

    Null and empty texts have no spans; texts of any length are scanned whole, row by row, without
    a shuffle. Repeated rows get a row each, an empty table gives an empty result, other columns
    are not looked at.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    bare = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    named = F.filter(places(text, ASSIGN, 1), lambda s: F.length(s["part"]) >= ASSIGN_LEAST)
    return rows.select(
        "doc_id",
        bare(named).alias("assign"),
        bare(places(text, ACCESS)).alias("access"),
        bare(places(text, HEX)).alias("hex"),
        high_entropy(text).alias("entropy"),
    )


def written(kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of all spans by start, then kind as listed, comma-joined."""
    def numbered(number: int, kind: str) -> Column:
        return F.transform(
            kind,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(number).alias("number"), s["end"].alias("end"), F.lit(kind).alias("kind")
            ),
        )

    spans = F.concat(*[numbered(number, kind) for number, kind in enumerate(kinds)])
    joined = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(joined, ",")


def secret_digests(found: DataFrame) -> DataFrame:
    """Counts and digests of ``find_secrets``: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    return found.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(written(KINDS[:3]).cast("binary"), 256).alias("base_sha256"),
        written(KINDS).alias("spans"),
    )
