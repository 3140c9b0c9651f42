"""Evaluation passages in a corpus, by template canonicalisation.

Numbers, names and units become typed placeholders, so that a passage and a
re-parameterised copy share their template. Windows of the template are joined by
hash, and so are shorter windows of the words themselves, which also lie between
slips that follow each other closely. For each pair of a document and an item that
share a window the run around it is then checked word for word: slots that were
kept make it a quotation, slots that were changed a re-parameterised copy.

The items are a stated query set, taken in blocks of bounded size; the blocks'
windows are the broadcast side of the hash join, every document is the other. The
corpus is read and cut to words once for eight blocks, and is never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.words import readings, words

MIN_RUN = 25
#: Words of a template window, and of a window of the words themselves.
WINDOW, EXACT = 13, 7
#: Slots kept for each slot changed, at least, in a quotation: a slip may hit a
#: slot, a re-parameterised copy changes most of them.
KEPT = 2
#: Passages of one block at most, characters of all of them, and blocks that one
#: pass over the corpus holds (about 20 MB each in a worker).
BLOCK_ITEMS, BLOCK_CHARS, PASS_BLOCKS = 2_000, 4_000_000, 8
VERBATIM, CHANGED = "verbatim", "re-parameterised"

_WORD = re.compile(r"[^\W\d_]+")


def case_of(text: str) -> tuple[set[str], set[str]]:
    """(words written with a capital, words written without one)."""
    upper: set[str] = set()
    lower: set[str] = set()
    for m in _WORD.finditer(text):
        w = m.group()
        (upper if w[0].isupper() else lower).add("".join(words(w)))
    return upper, lower


def _windows(ids: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of n word hashes."""
    if len(ids) < n:
        return np.empty(0, dtype=np.uint64)
    h = np.zeros(len(ids) - n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + ids[i : len(ids) - n + 1 + i]
            h ^= h >> np.uint64(29)
    return h


class Vocabulary:
    """The words of the whole query set, with their hashes as they are and as they
    stand in a template. So what counts as a slot doesn't depend on a block."""

    def __init__(self, texts: Iterable[str]) -> None:
        upper: set[str] = set()
        lower: set[str] = set()
        known: set[str] = set()
        for t in texts:
            u, low = case_of(t)
            upper |= u
            lower |= low
            known.update(words(t))
        self.names = frozenset(upper - lower)
        n = len(known)
        #: Unknown words have number 0, unknown numbers n + 1.
        self.number = {w: i + 1 for i, w in enumerate(sorted(known))}
        rng = np.random.default_rng(1)
        own = rng.integers(1, 1 << 63, n + 2, dtype=np.uint64)
        name, self.digits, self.unit = (rng.integers(1, 1 << 63, dtype=np.uint64) for _ in range(3))
        self._exact = own.copy()
        self._exact[[0, n + 1]] = 0
        # A word of a document that no passage has stands where a name may stand.
        self._template = own
        self._template[0], self._template[n + 1] = name, self.digits
        for w, i in self.number.items():
            if w[0].isdigit():
                self._template[i] = self.digits
            elif w in self.names:
                self._template[i] = name

    def numbers(self, ws: list[str]) -> np.ndarray:
        get, other = self.number.get, len(self.number) + 1
        return np.fromiter((get(w) or (other if w[0].isdigit() else 0) for w in ws), dtype=np.int64, count=len(ws))

    def ids(self, numbers: np.ndarray, template: bool) -> np.ndarray:
        """Hashes of the words; in a template with placeholders, what follows a
        number being its unit."""
        if not template:
            return self._exact[numbers]
        ids = self._template[numbers]
        after = np.nonzero((ids[:-1] == self.digits) & (ids[1:] != self.digits))[0] + 1
        ids[after] = self.unit
        return ids


class Items:
    """A block of items: words, and windows of templates and words with the places
    where they occur."""

    def __init__(self, rows: list[tuple[int, str]], vocabulary: Vocabulary | None = None, window: int = WINDOW, exact: int = EXACT) -> None:
        self.vocabulary = vocabulary or Vocabulary(t for _, t in rows)
        self.keys = [k for k, _ in rows]
        self.words = [words(t) for _, t in rows]
        self._sets = [self._index(False, exact), self._index(True, window)]

    def _index(self, template: bool, n: int) -> tuple:
        v = self.vocabulary
        hashes = [_windows(v.ids(v.numbers(ws), template), n) for ws in self.words]
        h = np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64)
        item = np.repeat(np.arange(len(hashes)), [len(x) for x in hashes])
        at = np.concatenate([np.arange(len(x)) for x in hashes]) if hashes else np.empty(0, dtype=np.int64)
        order = np.argsort(h, kind="stable")
        return n, template, h[order], item[order].astype(np.int32), at[order].astype(np.int32)

    def candidates(self, texts: list[list[str]]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, shift, position) of the windows that agree, in this order,
        where text position = passage position + shift. All texts are hashed at
        once, with gaps that no window of a passage runs across."""
        gap = max(n for n, *_ in self._sets)
        starts = np.cumsum([0] + [len(ws) + gap for ws in texts])
        numbers = np.zeros(starts[-1], dtype=np.int64)
        between = np.ones(starts[-1], dtype=bool)
        for s, ws in zip(starts.tolist(), texts, strict=False):
            numbers[s : s + len(ws)] = self.vocabulary.numbers(ws)
            between[s : s + len(ws)] = False
        found = []
        for n, template, hashes, item, at in self._sets:
            ids = self.vocabulary.ids(numbers, template)
            ids[between] = 0
            h = _windows(ids, n)
            lo = np.searchsorted(hashes, h, side="left")
            hits = np.nonzero(hashes[np.minimum(lo, max(len(hashes) - 1, 0))] == h)[0] if len(hashes) else np.empty(0, dtype=np.int64)
            lo = lo[hits]
            count = np.searchsorted(hashes, h[hits], side="right") - lo
            hits = np.repeat(hits, count)
            inner = np.arange(len(hits)) - np.repeat(np.cumsum(count) - count, count)
            slot = np.repeat(lo, count) + inner
            text = np.searchsorted(starts, hits, side="right") - 1
            place = hits - starts[text]
            found.append(np.stack([text, item[slot].astype(np.int64), place - at[slot], place]))
        all_ = np.concatenate(found, axis=1)
        yield from zip(*all_[:, np.lexsort(all_[::-1])].tolist(), strict=True)


_RIGHT, _SLOT_KEPT, _SLOT_CHANGED, _SLIP = 0, 1, 2, 3


def run_around(doc: list[str], item: list[str], shift: int, at: int, names: frozenset[str] = frozenset()) -> tuple[list[int], int]:
    """(what became of each word of the item's passage that runs on in the text
    around position ``at``, last text position of the run). A slip in a single word
    (another word, one too many, one missing) doesn't end the run if two right
    words follow. Slots are the passage's numbers and names."""
    sides: list[list[int]] = []
    end = at
    for step in (1, -1):
        marks: list[int] = []
        i, j = (at, at - shift) if step > 0 else (at - 1, at - shift - 1)
        while 0 <= i < len(doc) and 0 <= j < len(item):
            w = item[j]
            if doc[i] == w:
                marks.append(_SLOT_KEPT if w in names or w[0].isdigit() else _RIGHT)
                i, j = i + step, j + step
                continue

            def ahead(a: int, b: int, step: int = step) -> bool:
                n = 0
                while n < 2 and 0 <= a < len(doc) and 0 <= b < len(item) and doc[a] == item[b]:
                    a, b, n = a + step, b + step, n + 1
                return n == 2 or n == 1 and not 0 <= b < len(item)

            for da, db in ((1, 1), (1, 0), (0, 1), (2, 1), (1, 2)):
                if ahead(i + step * da, j + step * db):
                    # A wrong word stands for one of the passage's; the run goes on over it.
                    if min(da, db):
                        marks.append(_SLOT_CHANGED if w in names or w[0].isdigit() else _SLIP)
                    i, j = i + step * da, j + step * db
                    break
            else:
                break
        sides.append(marks)
        if step > 0:
            end = i
    return sides[1][::-1] + sides[0], end


def kind_of(marks: list[int], min_run: int = MIN_RUN) -> str | None:
    """Verbatim if some stretch of ``min_run`` words kept its slots, KEPT for each
    changed one; re-parameterised if only the run is long enough; None if not."""
    if len(marks) < min_run:
        return None
    kept = changed = 0
    for n, m in enumerate(marks):
        kept += m == _SLOT_KEPT
        changed += m == _SLOT_CHANGED
        if n >= min_run:
            out = marks[n - min_run]
            kept -= out == _SLOT_KEPT
            changed -= out == _SLOT_CHANGED
        if n >= min_run - 1 and kept >= KEPT * changed:
            return VERBATIM
    return CHANGED


def leaks_in(texts: list[list[str]], items: Items, min_run: int = MIN_RUN) -> dict[tuple[int, int], str]:
    """{(text, item): kind} where the text holds at least ``min_run`` consecutive
    words of the item's passage, placeholders for their slots."""
    found: dict[tuple[int, int], str] = {}
    before, until = None, -1
    for t, item, shift, p in items.candidates(texts):
        if found.get((t, item)) == VERBATIM or (before == (t, item, shift) and p < until):
            continue
        marks, until = run_around(texts[t], items.words[item], shift, p, items.vocabulary.names)
        before = (t, item, shift)
        kind = kind_of(marks, min_run)
        if kind:
            found[t, item] = VERBATIM if VERBATIM in (kind, found.get((t, item))) else CHANGED
    return found


def _rows(items: DataFrame) -> Iterator[tuple[int, str]]:
    """The query set in a fixed order, a partition on the driver at a time."""
    held = items.select("item_id", "passage").filter("item_id is not null and passage is not null").distinct().orderBy("item_id", "passage")
    yield from ((r.item_id, r.passage) for r in held.toLocalIterator())


def _blocks(rows: Iterator[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    block: list[tuple[int, str]] = []
    chars = 0
    for item_id, passage in rows:
        if block and (len(block) >= BLOCK_ITEMS or chars + len(passage) > BLOCK_CHARS):
            yield block
            block, chars = [], 0
        block.append((item_id, passage))
        chars += len(passage)
    if block:
        yield block


def find_leaks(documents: DataFrame, items: DataFrame, min_run: int = MIN_RUN, window: int = WINDOW, exact: int = EXACT) -> DataFrame:
    """Distinct (item_id, doc_id, kind), one kind a pair. Null and empty texts hold
    nothing; passages of fewer than ``min_run`` words can't be found; of an item id
    on several rows each passage counts, under its id. A block of items is at most
    2,000 passages or 4 million characters, and a pass takes eight blocks, the
    bound of what goes to each task besides the words of all items, which are taken
    first."""
    spark = documents.sparkSession
    slim = documents.select("doc_id", "text")
    vocabulary = Vocabulary(t for _, t in _rows(items))
    blocks = (Items(block, vocabulary, window, exact) for block in _blocks(_rows(items)))
    out = None
    while some := list(islice(blocks, PASS_BLOCKS)):
        held = spark.sparkContext.broadcast(some)

        def scan(batches: Iterator, held=held) -> Iterator:  # noqa: ANN001
            import pyarrow as pa

            for b in batches:
                doc_ids = b.column(0).to_pylist()
                rows: list[tuple[int, int, str]] = []
                for lo in range(0, len(doc_ids), 512):
                    read = [(lo + n, ws) for n, t in enumerate(b.column(1)[lo : lo + 512].to_pylist()) for ws in readings(t)]
                    for index in held.value:
                        leaks = leaks_in([ws for _, ws in read], index, min_run)
                        rows += [(index.keys[i], doc_ids[read[t][0]], kind) for (t, i), kind in leaks.items()]
                types = (pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], ty) for c, ty in enumerate(types)], ["item_id", "doc_id", "kind"])

        part = slim.mapInArrow(scan, "item_id bigint, doc_id bigint, kind string")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return slim.select(F.lit(None).cast("bigint").alias("item_id"), F.col("doc_id").cast("bigint"), F.lit(None).cast("string").alias("kind")).limit(0)
    # "verbatim" is the greater text: it wins where passages of one item differ in kind.
    return out.groupBy("item_id", "doc_id").agg(F.max("kind").alias("kind"))
