"""Personal data by fixed forms and by bootstrapped context.

Seeds are the matches of four fixed forms. Words around a seed make lexical patterns: two words to
its left, or one word on either side. Patterns and the identifiers seen in them form a graph that
Spark scores in rounds: a pattern's confidence for a kind is the share of its identifiers known to
be of that kind, an identifier's score joins the confidences of its patterns, and identifiers that
reach MIN_SCORE count as known in the next round. Patterns that end with MIN_CONFIDENCE then mark
every identifier of the kind's looser form that they enclose, also such as no fixed form matches.

The graph covers all documents; only identifiers enter it: words with a digit or an @, and runs of
digit groups joined by spaces, dots, dashes and brackets, of whatever length. A word within a run
that has its kind is part of the run. Nothing is collected: patterns reach the mentions by an
equality join.

Defined results: a null text is an empty text without spans; positions are code points, end
exclusive; overlapping spans of different kinds are all reported, and are redacted as one; repeated
rows and rows without id are treated like all others, as spans depend on the text alone.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.scratch import settle

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_SUPPORT = 3  # known identifiers that a pattern must enclose
MIN_CONFIDENCE = 0.8
MIN_SCORE = 0.9

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A start within a run of digits matches only if the run's start does.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")
_CANDIDATE = re.compile(r"[^\s]*[0-9@][^\s]*")
# Digit groups within one line; the lookarounds keep parts of words out.
_RUN = re.compile(r"(?<![\w@.+-])[+(]?[0-9]++(?:[\x20().-]{1,3}[0-9]++)+(?![\w@])")
_EDGE = "\"'()[]{}<>,.;:!?#$%&*|="
_WORD = re.compile(r"[^\s]+")
_NEAR = 80  # characters on either side that can hold the words of a pattern


def _emails(text: str) -> list[tuple[int, int]]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        low = at
        while low > done and text[low - 1] in _LOCAL:
            low -= 1
        domain = _DOMAIN.match(text, at + 1) if low < at else None
        if domain:
            done = domain.end()
            found.append((low, done))
        at = text.find("@", max(at + 1, done))
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _ip_ok(parts: tuple[str, ...]) -> bool:
    short = [part.lstrip("0") for part in parts]
    return all(len(part) <= 3 and int(part or 0) <= 255 for part in short)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the fixed forms by kind, then start."""
    spans = [("email", *span) for span in _emails(text)] if "@" in text else []
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if _ip_ok(m.groups())]
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NO_DIGIT.sub("", m.group())) <= 15:
                spans.append(("phone", *m.span()))
    return spans


def loose_kinds(value: str) -> list[str]:
    """Kinds whose looser form an identifier has, which no fixed form matched."""
    digits = len(_NO_DIGIT.sub("", value))
    plain = re.fullmatch(r"[+(]?[0-9][0-9 ().-]*", value) is not None
    kinds = []
    if re.fullmatch(r"[^@\s]+@[^@\s]+", value):
        kinds.append("email")
    if re.fullmatch(r"[0-9A-Fa-f]{0,4}(?:[:.][0-9A-Fa-f]{0,4}){3,7}", value) and digits >= 4:
        kinds.append("ip")
    if plain and 12 <= digits <= 19:
        kinds.append("card")
    if plain and 7 <= digits <= 15:
        kinds.append("phone")
    return kinds


def _patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a span: words with a digit are no lexical context."""

    def plain(word: str) -> str:
        word = word.strip(_EDGE).lower()
        return "" if any(c.isdigit() or c == "@" for c in word) else word

    low = max(0, start - _NEAR)
    left = _WORD.findall(text, low, start)
    if low and left and not text[low - 1].isspace():
        left = left[1:]  # cut off by the bound
    right = _WORD.search(text, end, min(len(text), end + _NEAR))
    left = [w for w in (plain(w) for w in left) if w][-2:]
    after = plain(right.group()) if right else ""
    out = []
    if len(left) == 2:
        out.append(f"{left[0]} {left[1]} _")
    if left and after:
        out.append(f"{left[-1]} _ {after}")
    return out


def _runs(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, list[str]]]:
    """Runs of digit groups between the taken spans that have a loose form: start, end and kinds."""
    found, low = [], 0
    for high, after in [*taken, (len(text), len(text))]:
        for m in _RUN.finditer(text, low, max(low, high)):
            start, end = m.span()
            if text[start] == "(" and ")" not in m.group():
                start += 1
            kinds = loose_kinds(text[start:end])
            if kinds:
                found.append((start, end, kinds))
        low = max(low, after)
    return found


def mentions(text: str) -> list[dict]:
    """Base spans, and other identifiers with a loose form, with their value and patterns."""
    out, base = [], base_spans(text)
    for kind, start, end in base:
        out.append((kind, True, start, end))
    taken = sorted((start, end) for _, start, end in base)
    runs = _runs(text, taken)
    out += [(kind, False, start, end) for start, end, kinds in runs for kind in kinds]
    at = now = 0
    for m in _CANDIDATE.finditer(text):
        start, end = m.span()
        while start < end and text[start] in _EDGE:
            start += 1
        while end > start and text[end - 1] in _EDGE:
            end -= 1
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if any(s < end and start < e for s, e in taken[at : at + 1]):
            continue
        while now < len(runs) and runs[now][1] <= start:
            now += 1
        within = runs[now][2] if now < len(runs) and runs[now][0] <= start and end <= runs[now][1] else []
        out += [(kind, False, start, end) for kind in loose_kinds(text[start:end]) if kind not in within]
    return [
        {
            "kind": kind,
            "base": known,
            "start": start,
            "end": end,
            "value": text[start:end].lower(),
            "patterns": _patterns(text, start, end),
        }
        for kind, known, start, end in out
    ]


_MENTION = (
    "array<struct<kind:string,base:boolean,start:int,end:int,value:string,patterns:array<string>>>"
)


def _mentions_of(texts: pa.Array) -> pa.Array:
    likely = pc.fill_null(pc.match_substring_regex(texts, "[0-9@]"), False).to_pylist()
    found = [mentions(t.as_py()) if may else [] for t, may in zip(texts, likely, strict=True)]
    string = pa.string()
    kind = pa.struct(
        [
            ("kind", string), ("base", pa.bool_()), ("start", pa.int32()), ("end", pa.int32()),
            ("value", string), ("patterns", pa.list_(string)),
        ]
    )
    return pa.array(found, pa.list_(kind))


def with_mentions(docs: DataFrame, text: str = "text", into: str = "mentions") -> DataFrame:
    """Add all base spans and other identifiers of each text."""
    return docs.withColumn(into, F.arrow_udf(_mentions_of, _MENTION)(F.col(text)))


def confident_patterns(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, confidence) that bootstrapping from the base spans arrives at.

    found: mention rows with kind, base, value and patterns.
    """
    edges = settle(
        found.select("kind", "base", "value", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "kind", "value")
        .agg(F.max("base").alias("base"))
    )
    # An identifier may have several loose forms; it counts once in the size of a pattern.
    sizes = edges.groupBy("pattern").agg(F.countDistinct("value").alias("size"))
    known = edges.filter("base").select("kind", "value").distinct()
    patterns = None
    for _ in range(rounds):
        patterns = settle(
            edges.join(known, ["kind", "value"])
            .groupBy("pattern", "kind")
            .agg(F.count("*").alias("support"))
            .join(sizes, "pattern")
            .withColumn("confidence", F.col("support") / F.col("size"))
            .filter((F.col("support") >= MIN_SUPPORT) & (F.col("confidence") >= MIN_CONFIDENCE))
            .select("pattern", "kind", "confidence")
        )
        # 1 - product of (1 - confidence); the bound keeps the logarithm finite.
        doubt = F.sum(F.log1p(-F.least("confidence", F.lit(0.999))))
        won = (
            edges.filter("not base")
            .join(patterns, ["pattern", "kind"])
            .groupBy("kind", "value")
            .agg((1 - F.exp(doubt)).alias("score"))
            .filter(F.col("score") >= MIN_SCORE)
            .select("kind", "value")
        )
        known = settle(
            edges.filter("base").select("kind", "value").unionByName(won).distinct()
        )
    return patterns


def _text_key() -> Column:
    return F.sha2("text", 256)


def extra_spans(keyed: DataFrame) -> DataFrame:
    """(text_key, extra) of the texts in which patterns find more. keyed: text_key, mentions."""
    each = settle(
        keyed.filter(F.size("mentions") > 0)
        .select("text_key", F.inline("mentions"))
        .dropDuplicates(["text_key", "kind", "start", "end"])
    )
    won = (
        each.filter("not base")
        .select("text_key", "kind", "start", "end", F.explode("patterns").alias("pattern"))
        .join(confident_patterns(each), ["pattern", "kind"])
    )
    # One text's spans: bounded by its length.
    return won.groupBy("text_key").agg(F.collect_set(F.struct("kind", "start", "end")).alias("extra"))


def _base_of(mentions_column: str = "mentions") -> Column:
    base = F.filter(mentions_column, lambda m: m["base"])
    return F.transform(base, lambda m: F.struct(m["kind"], m["start"], m["end"]))


_NO_SPANS = "array<struct<kind:string,start:int,end:int>>"


SALTS = 32  # tasks over which the rows of one text meet the spans found in it


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans (base and discovered), arrays of (kind, start, end), of each row.

    Rows without other mentions than base ones cannot gain spans and pass by the last join.
    """
    # Texts stay behind; their rows are small from here on.
    rows = settle(
        with_mentions(docs.select("doc_id", "text"))
        .select("doc_id", _text_key().alias("text_key"), "mentions")
        .withColumn("base", _base_of())
        .withColumn("salt", F.monotonically_increasing_id() % SALTS)
    )
    extra = extra_spans(rows).withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    )
    open_ones = F.coalesce(F.exists("mentions", lambda m: ~m["base"]), F.lit(False))
    joined = rows.filter(open_ones).join(extra, ["text_key", "salt"], "left")
    return joined.unionByName(rows.filter(~open_ones), allowMissingColumns=True).select(
        "doc_id", "base", F.array_union("base", F.coalesce("extra", F.array().cast(_NO_SPANS))).alias("spans")
    )


def count_of(spans: str, kind: str) -> Column:
    """How many of the spans are of a kind, as long."""
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, by kind as in KINDS, then start, joined by commas."""
    place = F.array(*map(F.lit, KINDS))
    ranked = F.transform(
        spans, lambda s: F.struct(F.array_position(place, s["kind"]), s["start"], s["end"], s["kind"])
    )
    return F.array_join(
        F.transform(
            F.array_sort(ranked),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redact(docs: DataFrame) -> DataFrame:
    """All rows with base and discovered spans of text replaced by marks such as [EMAIL].

    n_chars, where it is present, becomes the length of the new text if it was that of the old.
    """
    columns = docs.columns
    # Only texts with a digit or an @ can have spans; the others pass by and are not shuffled.
    likely = F.coalesce(F.col("text").rlike("[0-9@]"), F.lit(False))
    some = docs.filter(likely)
    keyed = some.select("text", _text_key().alias("text_key"))
    rows = settle(with_mentions(keyed).select("text_key", "mentions"))
    extra = extra_spans(rows)

    @F.arrow_udf("string")
    def masked(texts: pa.Array, more: pa.Array) -> pa.Array:
        out = []
        for text, extras in zip(texts.to_pylist(), more.to_pylist(), strict=True):
            spans = base_spans(text) + [(s["kind"], s["start"], s["end"]) for s in extras or []]
            parts, at = [], 0
            for start, end, kind in sorted((s, -e, k) for k, s, e in spans):
                if start >= at:
                    parts += [text[at:start], f"[{kind.upper()}]"]
                at = max(at, -end)
            out.append("".join([*parts, text[at:]]))
        return pa.array(out, pa.string())

    keyed = some.withColumn("__key", _text_key())
    new = (
        keyed.join(extra.select(F.col("text_key").alias("__key"), F.col("extra").alias("__extra")), "__key", "left")
        .withColumn("__masked", masked(F.col("text"), F.col("__extra")))
    )
    if "n_chars" in columns:
        was = F.col("n_chars") == F.length("text")
        new = new.withColumn(
            "n_chars", F.when(was, F.length("__masked")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
        )
    new = new.withColumn("text", F.col("__masked")).select(*columns)
    return docs.filter(~likely).unionByName(new)
