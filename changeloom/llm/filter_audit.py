"""Interaction audit of quality filters: what each removes in every order of applying them.

A table-driven transducer reads the UTF-8 bytes of a text once. A byte has a class, and a table gives for each state and
class the next state and what to emit: a word begins, a word ends, a capital, a code point, a symbol. The next state
depends on the byte's class alone, so the states of a whole block of bytes are one lookup, and so are its emissions;
only the last state is handed on to the next block. The spans of words go into a hash table that compares the bytes of
words with equal hashes, so what it counts as distinct is distinct.

Which filters a document fails is a bit mask. Masks are counted in Spark for each part, and from these counts alone
follow all orders and steps.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import staged, with_python

#: The filters by bit, the first one lowest.
FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
#: White space, and the symbols that filter D looks for.
BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#$%&*|"

BLANK, CAPITAL, SYMBOL, INSIDE, OTHER = range(5)
GAP, WORD = range(2)
BEGINS, ENDS, A_CAPITAL, A_POINT, A_SYMBOL = (1 << k for k in range(5))
#: Bytes that are looked up at once.
BLOCK = 1 << 20


def _byte_classes() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    table[list(BLANKS)] = BLANK
    table[ord("A") : ord("Z") + 1] = CAPITAL
    table[list(SYMBOLS)] = SYMBOL
    table[0x80:0xC0] = INSIDE  # of a code point
    return table


def _emissions() -> np.ndarray:
    """By state before the byte and class of the byte."""
    table = np.zeros((2, 5), np.uint8)
    table[:, [BLANK, CAPITAL, SYMBOL, OTHER]] |= A_POINT
    table[:, CAPITAL] |= A_CAPITAL
    table[:, SYMBOL] |= A_SYMBOL
    table[GAP, [CAPITAL, SYMBOL, INSIDE, OTHER]] |= BEGINS
    table[WORD, BLANK] |= ENDS
    return table


CLASS = _byte_classes()
NEXT = np.array([GAP, WORD, WORD, WORD, WORD], np.uint8)
EMIT = _emissions()


class WordTable(set):
    """Hash table of words. An entry found by its hash counts only if its bytes agree, which is how sets compare."""

    def insert(self, data: memoryview, spans: Iterator[tuple[int, int]]) -> None:
        self.update(bytes(data[a:b]) for a, b in spans)


def transduce(data: bytes | memoryview, block: int = BLOCK) -> tuple[int, int, int, int, int]:
    """Words, different words, capitals, code points and symbols of a text."""
    data = memoryview(data)
    state, open_at = GAP, 0
    words = capitals = points = symbols = 0
    table = WordTable()
    for at in range(0, len(data), block):
        classes = CLASS[np.frombuffer(data[at : at + block], np.uint8)]
        after = NEXT[classes]
        before = np.concatenate((np.array([state], np.uint8), after[:-1]))
        out = EMIT[before, classes]
        points += int(np.count_nonzero(out & A_POINT))
        capitals += int(np.count_nonzero(out & A_CAPITAL))
        symbols += int(np.count_nonzero(out & A_SYMBOL))
        begins = (np.flatnonzero(out & BEGINS) + at).tolist()
        ends = (np.flatnonzero(out & ENDS) + at).tolist()
        words += len(begins)
        if state == WORD:
            begins.insert(0, open_at)
        table.insert(data, zip(begins, ends))
        state = int(after[-1])
        if state == WORD:
            open_at = begins[-1]
    if state == WORD:
        table.insert(data, iter([(open_at, len(data))]))
    return words, len(table), capitals, points, symbols


def failures(words: int, different: int, capitals: int, points: int, symbols: int) -> int:
    """Bit mask of the filters A to D that a text with these counts fails."""
    found = (
        words < MIN_WORDS,
        100 * different < MIN_DISTINCT_PERCENT * words,
        100 * capitals > MAX_CAPITAL_PERCENT * points,
        symbols > 0,
    )
    return sum(1 << k for k, failed in enumerate(found) if failed)


def with_counts(docs: DataFrame, text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """The columns ``keep`` of documents, what :func:`transduce` counts in their texts (null: empty), and ``failed``,
    the mask of the filters A to D. Texts are read whole, block by block."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    rows = with_python(docs.select(*[f"`{c}`" for c in keep], text.alias("__text")))
    names = ("words", "different_words", "capitals", "code_points", "symbols", "failed")
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [transduce(text.as_buffer()) for text in batch.column(batch.num_columns - 1)]
            found = [(*counts, failures(*counts)) for counts in found]
            columns = [pa.array(c, pa.int64()) for c in zip(*found)] or [pa.array([], pa.int64())] * len(names)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], *names])

    return rows.mapInArrow(count, schema + ", ".join(f"{n} long" for n in names))


def copies_of_smaller_ids(rows: DataFrame, digest: str, id_col: str, name: str) -> DataFrame:
    """The rows and whether another row of a smaller id has the same digest.

    The smallest id of a digest is an aggregate. Rows meet it by digest and id together, so a text that a third of the
    rows have does not bring them into one task. Rows of the smallest id and rows without id are no copies.
    """
    first = rows.groupBy(digest).agg(F.min(id_col).alias(id_col)).filter(F.col(id_col).isNotNull()).withColumn(name, F.lit(False))
    copies = F.coalesce(F.col(name), F.col(id_col).isNotNull())
    return rows.join(first, [digest, id_col], "left").withColumn(name, copies)


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part (source; null: empty), mask of failed filters, and labels: the number of documents ``n``.

    A label row counts by the document's id; ids with several label rows count as good or toxic if one of them says so.
    Labels without id belong to no document.
    """
    slim = docs.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)).alias("digest"),
        "text",
    )
    counted = with_counts(slim, keep=("doc_id", "part", "digest")).select("doc_id", "part", "digest", "failed")
    rows = copies_of_smaller_ids(staged(counted, "audit-documents"), "digest", "doc_id", "copy")
    marks = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    failed = F.col("failed") + F.when(F.col("copy"), 1 << FILTERS.index("E")).otherwise(0)
    good, toxic = (F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic"))
    rows = rows.join(marks, "doc_id", "left").select("part", failed.alias("failed"), good, toxic)
    return rows.groupBy("part", "failed", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))


def audit(counted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from documents counted by part, mask, good and toxic.

    A part's counts fit into arrays with one place a mask; all orders are read off these.
    """
    size = 1 << len(filters)
    steps = []
    for order in permutations(range(len(filters))):
        before = 0
        for k, f in enumerate(order):
            steps.append(("".join(filters[x] for x in order), k + 1, before, 1 << f))
            before |= 1 << f

    def tally(weight: str, name: str) -> Column:
        cells = (f"coalesce(sum(CASE WHEN failed = {m} THEN {weight} END), 0L)" for m in range(size))
        return F.expr(f"array({', '.join(cells)})").alias(name)

    def listed(values: Iterator) -> str:
        return f"array({', '.join(map(repr, values))})"

    parts = counted.groupBy("part").agg(
        tally("n", "all"), tally("CASE WHEN good THEN n ELSE 0L END", "good"), tally("CASE WHEN toxic THEN n ELSE 0L END", "toxic")
    )
    orders = ", ".join(map(listed, zip(*steps)))
    rows = parts.select("*", F.expr(f"inline(arrays_zip({orders}))").alias("filter_order", "step", "before", "bit"))

    def total(cells: str, holds: str, share: str = "1L") -> Column:
        """Sum over the masks m for which ``holds``."""
        step = f"CASE WHEN {holds} THEN {cells}[m] * {share} ELSE 0L END"
        return F.expr(f"aggregate(sequence(0, {size - 1}), 0L, (s, m) -> s + {step})")

    there, fails = "(m & before) = 0", "(m & bit) <> 0"
    # Of all orders, a filter comes first among the k that a document fails in one of k.
    shares = f"array({', '.join(f'{factorial(len(filters)) // max(1, m.bit_count())}L' for m in range(size))})"
    return rows.select(
        "part",
        "filter_order",
        "step",
        total("all", f"{there} AND NOT {fails}").alias("kept"),
        total("all", f"{there} AND {fails}").alias("removed"),
        total("all", f"NOT {there} AND {fails}").alias("redundant"),
        F.col("all")[F.col("bit")].alias("unique_fails"),
        total("good", f"{there} AND {fails}").alias("good_lost"),
        total("toxic", f"{there} AND {fails}").alias("toxic_lost"),
        total("all", fails, f"{shares}[m]").alias("shapley"),
    )


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of whole documents.

    Null texts are empty: they fail A, and E if an earlier one is empty or null too. Repeated rows count each; rows that
    agree in id and text are no copies of each other. Documents without id are never copies and make none. An empty table
    has no parts and gives no rows.
    """
    return audit(staged(masks(docs, labels), "audit-masks"))


SQL = """
    WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
    marks AS (
        SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
    ), measured AS (
        SELECT doc_id, part, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words,
               length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals, length(t) AS points,
               regexp_matches(t, '[#$%&*|]') AS symbol, min(doc_id) OVER (PARTITION BY t) AS first_id
        FROM texts
    ), flags AS (
        SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic, {
            'A': len(words) < 200,
            'B': 100 * len(list_distinct(words)) < 50 * len(words),
            'C': 100 * capitals > 2 * points,
            'D': symbol,
            'E': coalesce(doc_id > first_id, FALSE)} AS f
        FROM measured LEFT JOIN marks USING (doc_id)
    ), masks AS (
        SELECT part, good, toxic,
               [f.A, f.B, f.C, f.D, f.E] AS fails, count(*) AS n
        FROM flags GROUP BY ALL
    ), letters AS (SELECT unnest(range(1, 6)) AS x),
    orders AS (
        SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
    ), steps AS (
        SELECT array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, k AS step,
               o[k] AS own, o[1:k - 1] AS earlier
        FROM orders, (SELECT unnest(range(1, 6)) AS k)
    ), told AS (
        SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS failed,
               len(list_filter(earlier, lambda x: fails[x])) > 0 AS gone,
               len(list_filter(fails, lambda x: x)) AS failures
        FROM masks, steps
    ), audit AS (
        SELECT part, filter_order, step, own,
               sum(CASE WHEN NOT gone AND NOT failed THEN n ELSE 0 END) AS kept,
               sum(CASE WHEN NOT gone AND failed THEN n ELSE 0 END) AS removed,
               sum(CASE WHEN gone AND failed THEN n ELSE 0 END) AS redundant,
               sum(CASE WHEN failed AND failures = 1 THEN n ELSE 0 END) AS unique_fails,
               sum(CASE WHEN NOT gone AND failed AND good THEN n ELSE 0 END) AS good_lost,
               sum(CASE WHEN NOT gone AND failed AND toxic THEN n ELSE 0 END) AS toxic_lost
        FROM told GROUP BY ALL
    )
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
           CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
    FROM audit
"""
