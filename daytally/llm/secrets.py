"""Secret scans in DataFrame functions: three fixed patterns, and entropy over candidate strings.

Positions come from the two halves of a regular expression: the matches and the pieces between
them, whose lengths add up. Entropy spans are runs of key-like characters in which some window of
WINDOW characters has, for the run's character class, more Shannon entropy than prose or
identifiers have. A window slides by one character: one count goes up, one goes down, and the sum
of n * log2(n) over the counts changes by two table values. Runs on the allow list (UUIDs, dates,
words joined by separators) and runs that touch a pattern's span are not reported.

Only documents with a match pay for positions; only candidate strings pay for windows. A run of a
megabyte or a document of a hundred thousand matches takes seconds: whatever a lambda needs is bound
once, and running sums and maxima go in two levels of blocks, as arrays that grow by one copy all.

Defined cases: a null text counts as empty and has no spans; spans are in code points, end
exclusive, ordered by start, then kind as in KINDS; spans of different kinds may overlap; repeated
rows are reported each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import plain_docs

# The patterns of known secrets and the least length of what they must find.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

KINDS = ("assign", "access", "hex", "entropy")
#: Characters of one entropy window; a candidate is a run of key characters at least that long.
WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: Character classes in order of test, and the bits a window must exceed; digits alone are never secrets.
CLASSES = (
    ("digits", r"^[0-9_=/+-]+$", None),
    ("hex", r"^[0-9a-fA-F]+$", 2.9),
    ("letters", r"^[A-Za-z_=/+-]+$", 4.05),
    ("mixed", r"", 3.6),
)
#: Runs that look random but are not secret: UUIDs, whole dates and times (with fraction and zone), and
#: words of one case joined by separators. Letters without a break for a window or more are tested like any other run.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T_-]+[0-9]{2}([-_]?[0-9]{2}){0,2}([-_]?[0-9]{3,9})?(Z|[+_-][0-9]{2}[-_]?[0-9]{2})?)?[_=/+-]*$",
    # Possessive, so that a long run of words doesn't recurse.
    r"^[A-Z]?[a-z]{1,18}(?:[_/=+-]+[A-Za-z]?[a-z]{0,18})*+$",
    r"^[A-Z]{1,19}(?:[_/=+-]+[A-Z]{0,19})*+$",
)

SPAN = "array<struct<start:int,rank:int,stop:int>>"
SHOWN = "[SECRET]"
#: Elements of one block of a running value, and spans of one block of a redaction.
BLOCK = 128


def _none() -> Column:
    return F.array().cast(SPAN)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often and in whatever lambda it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _cut(values: Column) -> Column:
    """The array in blocks of BLOCK elements."""
    starts = lambda all_: F.sequence(F.lit(1), F.greatest(F.size(all_), F.lit(1)), F.lit(BLOCK))
    return _bound(values, lambda all_: F.transform(starts(all_), lambda at: F.slice(all_, at, BLOCK)))


def _running(values: Column, join: Callable[[Column, Column], Column], zero: int) -> Column:
    """For each integer the join of zero and all up to it: within blocks first, then over the blocks' ends."""

    def scan(row: Column) -> Column:
        begin = F.array(F.lit(zero))
        return F.aggregate(row, begin, lambda done, value: F.concat(done, F.array(join(F.element_at(done, -1), value))))

    def whole(inner: Column) -> Column:
        before = scan(F.transform(inner, lambda block: F.element_at(block, -1)))
        own = lambda block, start: F.transform(F.slice(block, 2, BLOCK), lambda value: join(start, value))
        # There is one start more than blocks; the last pairs with no block.
        return F.flatten(F.zip_with(inner, F.slice(before, 1, F.size(inner)), own))

    return _bound(F.transform(_cut(values), scan), whole)


def _places(text: Column, pattern: str, rank: int, keep: Column | None = None) -> Column:
    """Spans of all leftmost non-overlapping matches; ``keep`` may hold one boolean per match."""
    pieces = F.transform(F.split(text, pattern, -1), F.length)
    matches = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.length(found))

    def placed(both: Column) -> Column:
        stops = _running(F.transform(both, lambda pair: pair["piece"] + pair["match"]), lambda a, b: a + b, 0)
        rows = F.arrays_zip(stops.alias("stop"), both["match"].alias("match"), both["keep"].alias("keep"))
        span = lambda row: F.struct((row["stop"] - row["match"]).alias("start"), F.lit(rank).alias("rank"), row["stop"].alias("stop"))
        return F.transform(F.filter(rows, lambda row: row["keep"]), span)

    # The last piece has no match after it.
    kept = F.transform(matches, lambda _: F.lit(True)) if keep is None else keep
    pairs = F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("piece"), matches.alias("match"), kept.alias("keep"))
    return F.when(text.rlike(pattern), _bound(pairs, placed)).otherwise(_none())


def window_bits(run: Column) -> Column:
    """The highest Shannon entropy, in bits, of any window of the run (ASCII, at least WINDOW long)."""
    weights = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(WINDOW + 1)])
    begin = F.struct(F.lit(0.0).alias("sum"), F.lit(1e9).alias("least"))

    def change(before: Column, come: Column, go: Column) -> Column:
        """What the sum gains when ``come`` enters and ``go`` (null: nothing) leaves the characters before it."""
        count = lambda c: F.size(before) - F.size(F.array_remove(before, c))
        more = _bound(count(come), lambda n: F.get(weights, n + 1) - F.get(weights, n))
        less = _bound(count(go), lambda n: F.get(weights, n - 1) - F.get(weights, n))
        return F.when(go.isNull(), more).when(come == go, 0.0).otherwise(more + less)

    def steps(codes: Column) -> Column:
        def one(come: Column, i: Column) -> Column:
            before = F.slice(codes, F.greatest(i - WINDOW, F.lit(0)) + 1, F.least(i, F.lit(WINDOW)))
            # An index below zero gives null: no character leaves yet.
            return F.struct(change(before, come, F.get(codes, i - WINDOW)).alias("change"), (i >= WINDOW - 1).alias("full"))

        return F.transform(codes, one)

    def step(state: Column, now: Column) -> Column:
        total = state["sum"] + now["change"]
        least = F.when(now["full"], F.least(state["least"], total)).otherwise(state["least"])
        return F.struct(total.alias("sum"), least.alias("least"))

    return F.aggregate(_bound(F.split(run, ""), steps), begin, step, lambda state: F.lit(math.log2(WINDOW)) - state["least"] / WINDOW)


def is_secret(run: Column) -> Column:
    """Whether a candidate's class, entropy and the allow list make it a secret."""
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | run.rlike(pattern)
    needed = F.when(allowed, F.lit(None).cast("double"))
    for _, pattern, bits in CLASSES:
        needed = needed.when(run.rlike(pattern), F.lit(bits).cast("double"))
    return F.when(needed.isNull(), False).otherwise(window_bits(run) > needed)


def _with_spans(frame: DataFrame) -> DataFrame:
    """Adds _base and _spans for the column _text."""
    text = F.col("_text")
    values = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda value: F.length(value) >= ASSIGN_VALUE)
    known = F.concat(_places(text, ASSIGN, 0, values), _places(text, ACCESS, 1), _places(text, HEX, 2))
    secret = F.transform(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), is_secret)
    both = frame.withColumn("_base", F.sort_array(known)).withColumn("_more", _places(text, CANDIDATE, 3, secret))
    return both.withColumn("_spans", _untouched(F.sort_array(F.concat("_base", "_more")))).drop("_more")


def _untouched(spans: Column) -> Column:
    """Spans in order, without those of entropy that meet a pattern's span.

    A pattern's span that starts no later stands before (its rank is lower) and meets it by its end;
    one that starts later meets it by its start.
    """
    last, far = KINDS.index("entropy"), 2**31 - 1

    def kept(all_: Column) -> Column:
        ends = _running(F.transform(all_, lambda s: F.when(s["rank"] < last, s["stop"]).otherwise(0)), F.greatest, 0)
        starts = F.transform(F.reverse(all_), lambda s: F.when(s["rank"] < last, s["start"]).otherwise(far))
        rows = F.arrays_zip(all_.alias("span"), ends.alias("end"), F.reverse(_running(starts, F.least, far)).alias("next"))
        own = lambda row: row["span"]
        alone = lambda row: (own(row)["rank"] < last) | ((row["end"] <= own(row)["start"]) & (row["next"] >= own(row)["stop"]))
        return F.transform(F.filter(rows, alone), own)

    return F.when(F.size(spans) > 0, _bound(spans, kept)).otherwise(_none())


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, text, base (spans of the fixed patterns), spans (base and entropy), each in order."""
    found = _with_spans(plain_docs(docs).withColumnRenamed("text", "_text"))
    return found.select("doc_id", F.col("_text").alias("text"), F.col("_base").alias("base"), F.col("_spans").alias("spans"))


def without_secrets(docs: DataFrame) -> DataFrame:
    """docs with every secret replaced by SHOWN; a column n_chars follows the text, others stay as they are."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.coalesce("text", F.lit("")).alias("_text"))
    found = _with_spans(rows).withColumn("_clean", redacted(F.col("_text"), F.col("_spans")))
    changed = F.size("_spans") > 0
    new = {"text": F.col("_clean"), "n_chars": F.length("_clean")}
    own = lambda c: F.col("_row")[c]
    kinds = dict(docs.dtypes)
    columns = [F.when(changed, new[c].cast(kinds[c])).otherwise(own(c)).alias(c) if c in new else own(c).alias(c) for c in docs.columns]
    return found.select(*columns)


def shown(spans: Column) -> Column:
    """kind:start:stop of the spans, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    one = lambda span: F.concat_ws(":", F.get(names, span["rank"]), span["start"], span["stop"])
    return F.array_join(F.transform(spans, one), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda span: span["rank"] == KINDS.index(kind))).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by SHOWN.

    A block of spans is cut out of the text first, so that each span counts characters from there.
    """

    def part(block: Column) -> Column:
        begin, end = F.element_at(block, 1)["at"], F.element_at(block, -1)["start"]

        def pieces(chunk: Column) -> Column:
            before = lambda row: F.substring(chunk, row["at"] - begin + 1, row["start"] - row["at"])
            shown_ = lambda row: F.when(row["start"] < row["at"], F.lit("")).otherwise(F.concat(before(row), F.lit(SHOWN)))
            return F.array_join(F.transform(block, shown_), "")

        return _bound(F.substring(text, begin + 1, end - begin), pieces)

    def whole(all_: Column) -> Column:
        def joined(ends: Column) -> Column:
            rows = F.transform(all_, lambda s, i: F.struct(F.coalesce(F.get(ends, i - 1), F.lit(0)).alias("at"), s["start"].alias("start")))
            tail = F.substring(text, F.element_at(ends, -1) + 1, F.length(text))
            return F.concat(F.array_join(F.transform(_cut(rows), part), ""), tail)

        return _bound(_running(F.transform(all_, lambda s: s["stop"]), F.greatest, 0), joined)

    return F.when(F.size(spans) > 0, _bound(spans, whole)).otherwise(text)
