"""Keyword-stuffed pages, link lists, tag clouds, menus and goods lists.

Each page's words go through a suffix automaton. What is covered by repeated
maximal substrings (keywords, labels, tags), or is link markup, counts as list
material, in characters and the more the longer and the more often a substring is
repeated; sentences with clause structure count against it. A page is found if
list material makes up most of it and clauses don't.

Which words tie clauses together is learned from the corpus itself: words that many
documents of a language have in common. No word list of any language is built in.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of the text's characters in list material above which a page is found, as
#: long as clauses are less than half of it and less than the list material.
LEAST_SHARE, CLAUSE_SHARE = 0.3, 0.5
#: A sentence has clause structure from this share of different common words on ...
FUNCTION_SHARE = 0.2
#: ... unless more than this share of it is covered by repeats and it has not
#: even this share of common words.
MOST_COVERED, SURE_SHARE = 0.5, 0.28
#: A sentence of at least so many words that repeats don't cover has it too, which
#: is how a language that the corpus hardly holds is read.
PLAIN_WORDS = 6
#: Common words are in this share of a language's documents, where so many
#: documents without them are counted for it besides its own.
COMMON_SHARE, UNSEEN = 0.2, 30

#: A repeated substring of so many words is repetition in whole.
LONG = 10

_LINK = re.compile(r"<a\s[^>]*>|</?[a-z][^>]*>|\]\([^)\s]*\)|[a-z][a-z+]*://\S+|www\.\S+|\b[\w\-]{2,}(?:\.[\w\-]{2,})*\.[^\W\d_]{2,24}\b(?:[/?#:]\S*)?", re.IGNORECASE)
#: What every link but markup and addresses with a scheme holds.
_DOTTED = re.compile(r"\w\.[^\W_]")
_WORD = re.compile(r"[^\W_]+")
_TOKEN = re.compile(r"[^\W_]+|[.!?](?=\s|$)|\n|\x00+")


class SuffixAutomaton:
    """Suffix automaton of a sequence of words, with occurrence counts. Most states
    have one way on, kept in two lists; only branching ones have a dict."""

    __slots__ = ("count", "ends", "length", "link", "more", "symbol", "target")

    def __init__(self, sequence: list) -> None:
        self.symbol, self.target, self.more = [None], [0], {}
        self.link, self.length, self.count = [-1], [0], [0]
        self.ends: list[int] = []
        symbol, target, more, link, length, count = self.symbol, self.target, self.more, self.link, self.length, self.count

        def state(n: int, c: int) -> int:
            symbol.append(None)
            target.append(0)
            length.append(n)
            count.append(c)
            link.append(0)
            return len(length) - 1

        def go(p: int, x) -> int:  # noqa: ANN001
            if symbol[p] == x:
                return target[p]
            return more[p].get(x, -1) if p in more else -1

        def put(p: int, x, q: int) -> None:  # noqa: ANN001
            if symbol[p] is None or symbol[p] == x:
                symbol[p], target[p] = x, q
            else:
                more.setdefault(p, {})[x] = q

        last = 0
        for x in sequence:
            new = state(length[last] + 1, 1)
            p, q = last, -1
            while p != -1:
                q = go(p, x)
                if q != -1:
                    break
                put(p, x, new)
                p = link[p]
            if p != -1:
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    clone = state(length[p] + 1, 0)
                    symbol[clone], target[clone], link[clone] = symbol[q], target[q], link[q]
                    if q in more:
                        more[clone] = more[q].copy()
                    while p != -1 and go(p, x) == q:
                        put(p, x, clone)
                        p = link[p]
                    link[q] = link[new] = clone
            last = new
            self.ends.append(new)
        for s in sorted(range(1, len(length)), key=length.__getitem__, reverse=True):
            if link[s] > 0:
                count[link[s]] += count[s]

    def weights(self) -> list[float]:
        """For each position, how much it is repetition: the greatest 1 - c^-k of
        the maximal substrings that cover it, k words that occur c times; LONG
        words and more count whole, which is at most 0.001 more. A word that is
        there twice counts half, a phrase of three that is there twice seven
        eighths, what occurs once nothing. Linear in the sequence: a position's
        substrings are looked at up to LONG words, and long ones meet in one sweep."""
        link, length, count = self.link, self.length, self.count
        n = len(self.ends)
        out = [0.0] * n
        reach = n
        for i in range(n - 1, -1, -1):
            s = self.ends[i]
            if count[s] == 1:
                # Along the links counts only grow.
                s = link[s]
            if s > 0 and length[s] >= LONG:
                reach = min(reach, i - length[s] + 1)
            else:
                while s > 0:
                    k = length[s]
                    w = 1.0 - float(count[s]) ** -k
                    for j in range(i, i - k, -1):
                        if out[j] < w:
                            out[j] = w
                    s = link[s]
            if reach <= i:
                out[i] = 1.0
        return out


def shares(text: str | None, common: frozenset[str] = frozenset()) -> tuple[float, float]:
    """(share of list material, share of sentences with clause structure) in the
    characters of the text's words and links; (0, 1) where there is nothing to judge.

    Bounds come first: no more can be covered than words that occur twice, and
    sentences with very many common words are clauses whatever is repeated. Where
    that already decides, (bound, bound) comes back without an automaton."""
    if not text:
        return 0.0, 1.0
    link_chars = 0

    def cut(m: re.Match) -> str:
        nonlocal link_chars
        link_chars += len(m.group())
        return " \x00 "

    body = _LINK.sub(cut, text) if "<" in text or "://" in text or "](" in text or _DOTTED.search(text) else text
    tokens = _TOKEN.findall(body.casefold())
    n = Counter(tokens)
    words = {w: k for w, k in n.items() if w[0].isalnum()}
    total = link_chars + sum(len(w) * k for w, k in words.items())
    bound = link_chars + sum(len(w) * k for w, k in words.items() if k > 1 and w not in common)
    if not total or bound <= LEAST_SHARE * total:
        return (bound / total if total else 0.0), 1.0

    def clauses(weights: list[float] | None) -> tuple[float, float]:
        """(characters in clauses, weighted characters covered); without weights
        only sentences count whose common words alone decide."""
        in_clauses = listed = inside = 0.0
        chars = k = 0
        tied_by: set[str] = set()
        ended = False
        for at, w in enumerate([*tokens, "."]):
            if w[0].isalnum():
                k += 1
                chars += len(w)
                if w in common:
                    tied_by.add(w)
                elif weights is not None:
                    inside += len(w) * weights[at]
            elif w in ".!?":
                ended = at < len(tokens)
                held = weights is not None and inside <= MOST_COVERED * chars
                function = len(tied_by)
                tied = k >= 2 and function >= FUNCTION_SHARE * k and (function >= SURE_SHARE * k or held)
                if tied or (held and ended and k >= PLAIN_WORDS):
                    in_clauses += chars
                listed += inside
                chars = k = 0
                tied_by.clear()
                inside = 0.0
        return in_clauses, listed

    sure, _ = clauses(None)
    if sure >= CLAUSE_SHARE * total:
        return bound / total, sure / total
    # Common words, breaks and links are each unlike anything else, so no repeat runs across them.
    marks = [w if w[0].isalnum() and w not in common else i for i, w in enumerate(tokens)]
    held, listed = clauses(SuffixAutomaton(marks).weights())
    return (link_chars + listed) / total, held / total


def is_stuffed(text: str | None, common: frozenset[str] = frozenset()) -> bool:
    listed, clauses = shares(text, common)
    return listed > LEAST_SHARE and clauses < min(CLAUSE_SHARE, listed)


def common_words(documents: DataFrame, lang: str | None = "lang") -> frozenset[str]:
    """Words that at least COMMON_SHARE of the documents of some language have,
    counted over all whole documents. A language with few documents gets UNSEEN
    more without any words, so that it takes its words from many texts. Spelling
    variants of a language's name are the same; unknown ones are one group.
    Without a column of languages the corpus is taken as of one language.

    What comes to the driver is bounded: a language has at most (words of a
    document) / COMMON_SHARE of them."""
    tag = F.coalesce(F.lower(F.trim(F.col(lang))), F.lit("")) if lang else F.lit("")

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[str, Counter] = {}
        size = 0

        def out():  # noqa: ANN202
            rows = [(g, w, k) for g, c in held.items() for w, k in c.items()]
            types = (pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["lang", "word", "n"])

        for b in batches:
            for g, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if t:
                    c = held.setdefault(g, Counter())
                    before = len(c)
                    c.update(set(_WORD.findall(t.casefold())))
                    size += len(c) - before
            if size > 500_000:
                yield out()
                held.clear()
                size = 0
        yield out()

    n = documents.select(tag.alias("lang"), "text").mapInArrow(count, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    total = documents.filter("text <> ''").groupBy(tag.alias("lang")).agg(F.count(F.lit(1)).alias("docs"))
    share = F.col("n") / (F.col("docs") + UNSEEN)
    words = n.join(total, "lang").filter(share >= COMMON_SHARE).select("word").distinct()
    return frozenset(r.word for r in words.toLocalIterator())


def find_stuffed(documents: DataFrame, common: frozenset[str] | None = None) -> DataFrame:
    """Distinct doc_id of the pages that are mostly lists of keywords, links, tags,
    labels or goods. Null and empty texts are none. Two passes over the documents
    (``common``: the words of an earlier first pass); what is shuffled are counts
    of words and the found ids."""
    if common is None:
        common = common_words(documents, "lang" if "lang" in documents.columns else None)
    held = documents.sparkSession.sparkContext.broadcast(common)

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            texts = b.column(1).to_pylist()
            found = [i for i, t in zip(b.column(0).to_pylist(), texts, strict=True) if is_stuffed(t, held.value)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["doc_id"])

    return documents.select("doc_id", "text").mapInArrow(scan, "doc_id bigint").distinct()
