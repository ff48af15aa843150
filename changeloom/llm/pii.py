"""Personal data: fixed expressions give seeds, and their contexts find identifiers that the expressions miss.

Seeds induce lexical patterns: the word before, the two words before, the word after, and both neighbours. Patterns
and instances form a graph that Spark scores in rounds: a pattern's confidence for a kind is the share of its
distinct instances that are known to be of the kind, where identifiers not known to be of any kind weigh little and
plain words in their place weigh fully; an instance's is the chance that not all of its patterns are wrong. Instances
that two contexts agree on, with high confidence, join the known ones and support further patterns, until a round
finds no more. Clock times and dates have the shape of no kind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.llm.common import staged, with_python

KINDS = ("email", "ip", "card", "phone")
#: A pattern is trusted from this share and this many distinct known instances on, an instance from this confidence on.
PATTERN_SHARE, PATTERN_SUPPORT, INSTANCE = 0.9, 8, 0.9
#: What an instance that is not known to be of any kind counts against a pattern; one known to be of another kind counts 1.
UNSEEN = 0.1
#: Patterns are sent to the tasks that look for them up to this number; beyond it, all that texts hold are joined with them.
SENT = 200_000
#: Share of the texts that are looked at first, to drop patterns that stand beside many words.
FIRST = 1 / 32
#: A task remembers the words of a pattern that may have up to this number.
KEPT = 64
#: Stands for an identifier among the words of a text.
_SLOT = "\0"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# From the start of a run of digits only: what begins inside one matches if and only if the run does.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What every match of the fixed expressions holds, and what every match of each shape holds.
_ANY = re.compile(r"[0-9@]")
#: Shapes that an identifier of a kind may have where no fixed expression holds.
_SHAPES = (
    re.compile(r"[^\s@<>\"',;:()\[\]]{1,64}(?:@|\(at\)|\[at\])[^\s@<>\"',;:()]{0,255}[^\s@<>\"',;:().!?]"),
    re.compile(r"(?<![\w.:])(?:[0-9A-Fa-f]{1,4}:){2,7}:?[0-9A-Fa-f]{1,4}(?![\w:])|(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w.])"),
    re.compile(r"(?<![\w-])[0-9](?:[\x20./-]?[0-9]){11,18}(?![\w-])"),
    re.compile(r"(?<![\w+])\(?[0-9]{2,5}\)?(?:[\x20./-]?[0-9]{2,5}){2,4}(?!\w)"),
)
#: What has such a shape as well, but is a clock time or begins with a date (year first, or last behind day and month).
_CLOCK = re.compile(r"(?:[01]?[0-9]|2[0-3])(?::[0-5][0-9]){2}")
_DATE = re.compile(
    r"\(?(?:(?:19|20)[0-9]{2}([\x20./-]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])"
    r"|(?:0?[1-9]|[12][0-9]|3[01])([\x20./-])(?:0?[1-9]|[12][0-9]|3[01])\2(?:19|20)[0-9]{2})(?![0-9./-])"
)
_SHAPED = (re.compile(r"@|\(at\)|\[at\]"), re.compile(r"[0-9:]"), re.compile(r"[0-9]"), re.compile(r"[0-9]"))


def _luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of what the fixed expressions find, by kind and start; in time proportional to the text."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            end = domain.end()
            found.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split(".")):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = re.sub(r"[\x20-]", "", m[0]) if m.end() - m.start() < 64 else ""
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((3, *m.span()))
    return found


def _patterns(text: str, start: int, end: int) -> list[str]:
    before = text[max(0, start - 64) : start].lower().split()[-2:]
    after = text[end : end + 48].lower().split()[:1]
    out = []
    if before:
        out.append(f"l {before[-1]}")
    if len(before) == 2:
        out.append("L " + " ".join(before))
    if after:
        out.append(f"r {after[0]}")
    if before and after:
        out.append(f"b {before[-1]} | {after[0]}")
    return out


def fillers(text: str, sought: frozenset[str] | None, lefts: frozenset[str], rights: frozenset[str]) -> set[tuple[str, str]]:
    """(pattern, word) of the words, not identifiers, that stand where a pattern has its instance.

    ``sought`` are the patterns, made of the words ``lefts`` and ``rights``; None stands for all there are.
    """
    end, parts = 0, []
    for a, b in sorted((a, b) for _, _, a, b, _, _ in mentions(text, base_spans(text))):
        if b > end:
            # A blank on either side: what touches an identifier is its neighbour, as in its patterns.
            parts += [text[end:a], f" {_SLOT} "] if a >= end else []
            end = b
    words = ["", *"".join([*parts, text[end:]]).lower().split(), ""]
    out = set()
    for k in range(len(words)) if sought is None else [k for k, w in enumerate(words) if w in lefts or w in rights]:
        near, after = words[k], words[k + 1] if k + 1 < len(words) else ""
        if after and near and after != _SLOT:
            out.add((f"l {near}", after))
            if k > 1:
                out.add((f"L {words[k - 1]} {near}", after))
            if words[k + 2]:
                out.add((f"b {near} | {words[k + 2]}", after))
        if k > 1 and near and words[k - 1] != _SLOT:
            out.add((f"r {near}", words[k - 1]))
    return out if sought is None else {(p, w) for p, w in out if p in sought}


def _is_time(text: str) -> bool:
    return bool(_CLOCK.fullmatch(text) or _DATE.match(text))


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, bool, int, int, str, list[str]]]:
    """(kind, known, start, end, instance, patterns) of the seeds and of whatever has the shape of a kind beside them."""
    out = [(k, True, a, b, text[a:b].lower(), _patterns(text, a, b)) for k, a, b in base]
    for kind, shape in enumerate(_SHAPES):
        for m in shape.finditer(text) if _SHAPED[kind].search(text) else ():
            a, b = m.span()
            if (kind != 3 or sum(c.isdigit() for c in m[0]) >= 7) and not _is_time(m[0]) and not any(a < y and x < b for _, x, y in base):
                out.append((kind, False, a, b, m[0].lower(), _patterns(text, a, b)))
    return out


_BASE = "array<struct<kind:int,start:int,end:int>>"
_SEEN = "array<struct<kind:int,known:boolean,start:int,end:int,instance:string,patterns:array<string>>>"


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        base = [base_spans(t) if t and _ANY.search(t) else [] for t in batch["text"]]
        seen = [mentions(t, b) if t else [] for t, b in zip(batch["text"], base, strict=True)]
        as_rows = [[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in base]
        names = ("kind", "known", "start", "end", "instance", "patterns")
        yield pd.DataFrame({
            "doc_id": batch["doc_id"], "uid": batch["uid"], "base": as_rows,
            "seen": [[dict(zip(names, m, strict=True)) for m in row] for row in seen],
        })


def words_in_place(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, words): how many distinct words stand where ``patterns`` (pattern, most) have their instances.

    Patterns with more than ``most`` words are left out; nobody asks for them again. Words only add up, so what some of
    the texts show to be beyond that need not be looked for in the others. The counts of the rest are of all texts.
    """
    seen = _words_met(texts.sample(FIRST, 1), patterns).filter("words > most").select("pattern")
    left = staged(patterns.join(seen, "pattern", "left_anti"), "pii-left")
    met = left.join(_words_met(texts, left).select("pattern", "words"), "pattern", "left")
    return met.select("pattern", "most", F.coalesce("words", F.lit(0)).alias("words")).filter("words <= most").drop("most")


def _words_met(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, most, words) of the patterns that stand beside a word; beyond ``most`` the count may be too low, but stays beyond."""
    few = patterns.limit(SENT + 1).collect()
    sought = frozenset(r["pattern"] for r in few) if len(few) <= SENT else None
    lefts = frozenset(p.split(" | ")[0].split()[-1] for p in sought or () if p[0] != "r")
    rights = frozenset(p.split()[-1] for p in sought or () if p[0] == "r")
    # A task keeps the words of patterns that bear few of them, and tells no more of those it knows to be beyond.
    bears = {r["pattern"]: r["most"] for r in few if r["most"] <= KEPT} if sought is not None else {}

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[str, set[str]] = {}
        for batch in batches:
            found = []
            for p, w in set().union(*(fillers(t, sought, lefts, rights) for t in batch["text"] if t)):
                if p in bears:
                    mine = kept.setdefault(p, set())
                    if len(mine) > bears[p] or w in mine:
                        continue
                    mine.add(w if len(w) <= 64 else hashlib.sha256(w.encode("utf-8", "replace")).hexdigest())
                found.append((p, w))
            yield pd.DataFrame(found, columns=["pattern", "word"])

    found = with_python(texts.select("text")).mapInPandas(look, "pattern string, word string")
    # Words are met as hashes: a text may be a single word.
    met = found.select("pattern", F.xxhash64("word").alias("word")).distinct().groupBy("pattern").agg(F.count("*").alias("words"))
    return met.join(patterns, "pattern").select("pattern", "most", "words")


def discovered(seen: DataFrame, texts: DataFrame) -> DataFrame:
    """(kind, instance) of the identifiers found through patterns, from rows (kind, known, instance, pattern) and the texts they are from."""
    edges = staged(seen.groupBy("pattern", "kind", "instance").agg(F.max("known").alias("known")), "pii-edges")
    # What a pattern surrounds, known or not: a text of several shapes counts once.
    spots = staged(edges.select("pattern", "instance").distinct(), "pii-spots")
    # Only these can gain enough support, however many of their instances become known.
    able = edges.groupBy("pattern", "kind").count().filter(F.col("count") >= PATTERN_SUPPORT)
    # With more words beside it a pattern is not trusted even if all its instances of a kind are known.
    most = F.floor(F.max("count") * (1 / PATTERN_SHARE - 1)).cast("long")
    able = staged(able.groupBy("pattern").agg(most.alias("most")), "pii-able")
    words = words_in_place(texts, able)
    around = staged(spots.groupBy("pattern").count().join(words, "pattern"), "pii-patterns")
    seeds = edges.filter("known").select("kind", "instance").distinct().withColumn("confidence", F.lit(1.0))
    known = staged(seeds, "pii-known")
    # Both patterns of the words before rest on the same word; one of both neighbours is an agreement by itself.
    one = F.when(F.col("pattern").startswith("L"), F.concat(F.lit("l "), F.element_at(F.split("pattern", " "), -1))).otherwise(F.col("pattern"))
    while True:
        support = edges.join(known, ["kind", "instance"]).groupBy("pattern", "kind").agg(
            F.sum("confidence").alias("sum"), F.count("*").alias("support")
        )
        named = spots.join(known.select("instance").distinct(), "instance").groupBy("pattern").agg(F.count("*").alias("named"))
        against = UNSEEN * (F.col("count") - F.col("named")) + F.col("words") + 0.5
        trusted = (
            support.filter(F.col("support") >= PATTERN_SUPPORT)
            .join(around, "pattern")
            .join(named, "pattern")
            .withColumn("share", F.col("sum") / (F.col("named") + against))
            .filter(F.col("share") >= PATTERN_SHARE)
            .select("pattern", "kind", "share")
        )
        found = (
            edges.filter("NOT known")
            .join(trusted, ["pattern", "kind"])
            .groupBy("kind", "instance")
            .agg(
                (1 - F.exp(F.sum(F.log(1 - F.col("share"))))).alias("confidence"),
                ((F.min(one) != F.max(one)) | F.bool_or(F.col("pattern").startswith("b"))).alias("agreed"),
            )
            .filter(F.col("agreed") & (F.col("confidence") >= INSTANCE))
            .drop("agreed")
        )
        new = staged(found.join(known, ["kind", "instance"], "left_anti"), "pii-found")
        if new.isEmpty():
            break
        known = staged(known.union(new), "pii-known")
    return known.join(seeds.select("kind", "instance"), ["kind", "instance"], "left_anti").select("kind", "instance")


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ``base`` and ``added`` (arrays of kind, start, end in code points, end exclusive) of every row.

    A null text is an empty one. Rows are told apart by their place, so repeated rows and null ids are fine; an empty
    table gives an empty result. Added spans never overlap a base span. Columns beside the two are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("uid", F.monotonically_increasing_id())
    id_type = rows.schema["doc_id"].dataType.simpleString()
    read = with_python(rows).mapInPandas(_extract, f"doc_id {id_type}, uid long, base {_BASE}, seen {_SEEN}")
    spans = staged(read, "pii-spans")
    one = spans.select("uid", F.explode("seen").alias("m")).select("uid", "m.*")
    new = discovered(one.select("kind", "known", "instance", F.explode("patterns").alias("pattern")), rows.filter("text IS NOT NULL"))
    added = (
        one.filter("NOT known")
        .join(new, ["kind", "instance"])
        .groupBy("uid")
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    )
    none = F.lit([]).cast(_BASE)
    return spans.join(added, "uid", "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))


def report(docs: DataFrame) -> DataFrame:
    """Counts by kind and digest of the base spans (added ones are not counted), and all spans written as kind:start:end, for every row."""
    found = find(docs)
    kinds = F.array(*map(F.lit, KINDS))

    def written(spans):
        return F.array_join(
            F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ","
        )

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast(T.LongType())

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        written(F.concat("base", "added")).alias("spans"),
    )
