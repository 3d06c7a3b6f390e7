"""Evaluation passages inside a corpus.

Search: Wu-Manber over normalised tokens.  Patterns are runs of a few tokens of
the evaluation sentences; a shift table over the last token skips positions
where no pattern can end, a bucket of the suffix selects patterns, and direct
comparison confirms them.  Every hit is then extended to both sides by token
comparison that lets single words differ, be missing or be added, and counts if
it covers a whole sentence or a long enough run of one.

Completeness: every stretch of a sentence that is long enough to count holds
``apart`` patterns without a common token, whatever other sentences hold.  So an
unaltered passage is never missed, and one with fewer altered tokens than
``apart`` still shows a pattern.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.sentences import sentences_of
from airloom.session import cut

_TOKEN = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}ー]|[\p{L}\p{M}\p{N}]+?(?=[\p{Han}\p{Hiragana}\p{Katakana}ー])|[\p{L}\p{M}\p{N}]+")
_CJK = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}ー]")
_INVISIBLE = re.compile("[\u00ad\u034f\u200b-\u200f\u2060-\u2064\ufeff]+")
_MARKS = re.compile("[\u0300-\u036f\u00ad\u200b-\u200f\u2060-\u2064\ufeff]+")
# scripts whose marks are letters of their own, or whose words need the full token rule
_OWN_RULES = re.compile("[\u0590-\u0fff\u3040-\u30ff\u3400-\u9fff\U00020000-\U0003ffff]")
# words that lose their marks in every document
_MARKED = regex.compile(r"(?=\P{ASCII})[\p{Latin}\p{Greek}\p{Cyrillic}][\p{M}]*|(?<=\p{ASCII})[\u0300-\u036f]+")
_PLAIN = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Rules:
    """What counts: run lengths in words (characters in scripts without blanks), patterns and tolerances."""

    run: int = 15
    run_cjk: int = 28
    quote: int = 5
    quote_cjk: int = 7
    pattern: int = 3  # tokens of a pattern
    pattern_cjk: int = 5
    apart: int = 3  # patterns without a common token in each passage: one more than the altered words that may hit them
    gap: int = 2  # tokens that may differ in a row
    matched: float = 0.82
    matched_cjk: float = 0.87
    weighted: float = 0.8


def tokens(text: str) -> list[str]:
    """Words (single characters in scripts without blanks) without case, punctuation and character forms."""
    if text.isascii():
        return _PLAIN.findall(text.lower())
    if _OWN_RULES.search(text):
        whole = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text).casefold())
        return _TOKEN.findall(_MARKED.sub(lambda m: _MARKS.sub("", unicodedata.normalize("NFKD", m.group())), whole))
    return _PLAIN.findall(_MARKS.sub("", unicodedata.normalize("NFKD", text)).casefold())


def is_cjk(words: list[str]) -> bool:
    return sum(1 for w in words if _CJK.match(w)) * 2 > len(words)


class WuManber:
    """Multi-pattern search over tokens; patterns are tuples of one length or more."""

    def __init__(self, patterns: dict[tuple, list]):
        self.m = m = min(map(len, patterns), default=1)
        self.shift: dict[str, int] = {}
        self.buckets: dict[tuple, list[tuple[tuple, list]]] = defaultdict(list)
        for p, posts in patterns.items():
            for i, w in enumerate(p[:m]):
                if m - 1 - i < self.shift.get(w, m):
                    self.shift[w] = m - 1 - i
            self.buckets[p[:m]].append((p, posts))
        self.buckets = dict(self.buckets)

    def find(self, d: list[str]) -> Iterator[tuple[int, list]]:
        """(start, postings) of every occurrence."""
        m, n, shift, buckets = self.m, len(d), self.shift.get, self.buckets
        at = m - 1
        while at < n:
            s = shift(d[at], m)
            if s:
                at += s
                continue
            start = at - m + 1
            for p, posts in buckets.get(tuple(d[start : at + 1]), ()):
                if len(p) == m or tuple(d[start : start + len(p)]) == p:
                    yield start, posts
            at += 1


@dataclass(frozen=True)
class Sentence:
    """One sentence of an item: its tokens, how many items have each, and how many items its language has."""

    item: object
    number: int
    words: list[str]
    owners: list[int]
    peers: int
    need: int
    cjk: bool


def needed(text: str, words: list[str], cjk: bool, rules: Rules) -> int:
    """Tokens that a passage of the sentence must cover; 0 if the sentence is a mere quote."""
    short = rules.quote_cjk if cjk else rules.quote
    if len(words) <= short:
        return 0
    # characters of ``run_cjk`` include punctuation
    run = max(1, math.floor(rules.run_cjk * len(words) / max(len(text.strip()), 1))) if cjk else rules.run
    return max(short + 1, min(len(words), run) - 2)


def patterns_of(s: Sentence, rules: Rules) -> list[int]:
    """Starts of the sentence's patterns: in every stretch of the needed length ``apart`` runs without a common token, the rarest that fit.

    A stretch too short for that keeps all its runs.
    """
    size = rules.pattern_cjk if s.cjk else rules.pattern
    n, apart = len(s.words) - size + 1, rules.apart
    if n <= 0:
        return [0]
    if s.need < apart * size + 1:
        return list(range(n))
    cost = [float(min(s.owners[i : i + size])) + sum(s.owners[i : i + size]) * 1e-6 for i in range(n)]
    kept: set[int] = set()
    for a in range(len(s.words) - s.need + 1):
        stop = a + s.need - size + 1
        # cheapest choice of so many disjoint runs that start in [a, stop), by dynamic programming from the right
        best: list[list[tuple[float, tuple]]] = [[(0.0, ())] * (s.need + size + 1)]
        for _ in range(apart):
            row: list[tuple[float, tuple]] = [(math.inf, ())] * (s.need + size + 1)
            for i in range(stop - 1, a - 1, -1):
                rest, chosen = best[-1][i - a + size]
                row[i - a] = min(row[i - a + 1], (rest + cost[i], (i, *chosen)))
            best.append(row)
        for i in best[-1][0][1]:
            kept.add(i)
            cost[i] = 0.0
    return sorted(kept)


class Detector:
    """Search structures for sentences of evaluation items."""

    def __init__(self, sentences: list[Sentence], rules: Rules = Rules()):
        self.rules = rules
        self.sentences = sentences
        self.weights = [[math.log(1 + s.peers / o) for o in s.owners] for s in sentences]
        found: dict[bool, dict[tuple, list]] = {False: defaultdict(list), True: defaultdict(list)}
        for k, s in enumerate(sentences):
            size = rules.pattern_cjk if s.cjk else rules.pattern
            for i in patterns_of(s, rules):
                found[s.cjk][tuple(s.words[i : i + size])].append((k, i))
        self.searches = [(cjk, WuManber(dict(p))) for cjk, p in found.items() if p]
    def _extend(self, s: list[str], i: int, d: list[str], j: int, step: int) -> list[int]:
        """Sentence positions matched from (i, j) on in direction ``step``."""
        out: list[int] = []
        gap, ns, nd = self.rules.gap, len(s), len(d)
        while 0 <= i < ns and 0 <= j < nd:
            if s[i] == d[j]:
                out.append(i)
                i += step
                j += step
                continue
            best = None
            for total in range(1, 2 * gap + 1):
                for a in range(max(0, total - gap), min(gap, total) + 1):
                    b = total - a
                    x, y = i + step * a, j + step * b
                    if 0 <= x < ns and 0 <= y < nd and s[x] == d[y]:
                        # unequal gaps need a second equal token, lest a frequent word bends the line
                        x2, y2 = x + step, y + step
                        sure = a == b or (0 <= x2 < ns and 0 <= y2 < nd and s[x2] == d[y2]) or not 0 <= x2 < ns
                        if sure and (best is None or abs(a - b) < abs(best[0] - best[1])):
                            best = (a, b)
                if best:
                    break
            # a word that differs counts as one step even if the next one differs too
            if not best:
                break
            i += step * best[0]
            j += step * best[1]
        return out

    def scan(self, text: str) -> dict[tuple, tuple[int, int]]:
        """(item, sentence) -> (tokens covered, tokens equal) of the best passage in the text."""
        d = tokens(text)
        found: dict[tuple, tuple[int, int]] = {}
        tried: dict[tuple[int, int], int] = {}
        for cjk, search in self.searches:
            if cjk and not _CJK.search(text):
                continue
            for j, posts in search.find(d):
                for k, i in posts:
                    if tried.get((k, j - i), -1) >= j:
                        continue
                    s = self.sentences[k]
                    right = self._extend(s.words, i, d, j, 1)
                    left = self._extend(s.words, i - 1, d, j - 1, -1)
                    # this diagonal is done as far as it is equal
                    tried[(k, j - i)] = j + next((n for n, x in enumerate(right) if x != i + n), len(right)) - 1
                    if len(left) + len(right) < self.rules.matched * s.need:
                        continue
                    dense = self.rules.matched_cjk if cjk else self.rules.matched
                    good = self._best(self.weights[k], left[::-1] + right, s.need, dense)
                    if good and good > found.get((s.item, s.number), (0, 0)):
                        found[(s.item, s.number)] = good
        return found

    def _best(self, w: list[float], at: list[int], need: int, dense: float) -> tuple[int, int] | None:
        """Longest stretch of the matched positions that is dense enough and of the needed length."""
        n = len(at)
        total = [0.0, *accumulate(w)]
        have = [0.0, *accumulate(w[x] for x in at)]
        best = (0, 0)
        for a in range(n):
            if at[-1] - at[a] + 1 < max(need, best[0]):
                break
            for b in range(n - 1, a - 1, -1):
                span = at[b] - at[a] + 1
                if span < need or (span, b - a + 1) <= best:
                    break
                if b - a + 1 >= dense * span and have[b + 1] - have[a] >= self.rules.weighted * (total[at[b] + 1] - total[at[a]]) - 1e-9:
                    best = (span, b - a + 1)
                    break
        return best if best[0] else None


def item_sentences(items: DataFrame, item_id: str, item_text: str, item_lang: str, rules: Rules) -> DataFrame:
    """Sentences that count, with token statistics over all items: item, number, words, owners, peers, need, cjk.

    owners: how many items have each token.  peers: how many items the language has.
    """
    kind = items.schema[item_id].dataType.simpleString()

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, t, lang in zip(b["item"], b["t"], b["lang"]):
                for k, (x, z) in enumerate(sentences_of(t or "", lang)):
                    words = tokens(t[x:z])
                    cjk = is_cjk(words)
                    out.append((i, lang, k, words, needed(t[x:z], words, cjk, rules), cjk))
            yield pd.DataFrame(out, columns=["item", "lang", "number", "words", "need", "cjk"])

    base = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("t"), F.col(item_lang).alias("lang")).filter("item is not null")
    schema = f"item {kind}, lang string, number int, words array<string>, need int, cjk boolean"
    # an item that comes twice is one item, known by all its sentences
    rows = cut(base.distinct().mapInPandas(split, schema).withColumn("s", F.monotonically_increasing_id()), "sentences")
    each = rows.select("s", "item", F.posexplode("words").alias("pos", "w"))
    owners = each.groupBy("w").agg(F.count_distinct("item").alias("n"))
    lists = each.join(owners, "w").groupBy("s").agg(F.sort_array(F.collect_list(F.struct("pos", "n"))).alias("o"))
    peers = base.groupBy(F.coalesce("lang", F.lit("")).alias("l")).agg(F.count_distinct("item").alias("peers"))
    out = rows.filter("need > 0").withColumn("l", F.coalesce("lang", F.lit(""))).join(lists, "s").join(peers, "l")
    return out.select("item", "number", "words", F.transform("o", lambda x: x["n"]).alias("owners"), "peers", "need", "cjk")


def leaks(docs: DataFrame, items: DataFrame, *, doc_id: str, text: str, item_id: str, item_text: str, item_lang: str,
          rules: Rules = Rules(), most_tokens: int = 400_000) -> DataFrame:
    """One row per document, item and sentence found: doc_id, item_id, sentence_no, n_covered, n_equal.

    The items are a query set.  Their statistics are made over all of them; their
    sentences then form blocks of at most ``most_tokens`` tokens (about 100 MB of
    search tables, the most that is broadcast), and every block is searched in all
    whole texts, so the result doesn't depend on the blocks.  NULL and empty texts
    hold nothing; repeated rows are reported each; items without id, text or a
    sentence above the length of a quote leak nowhere.
    """
    spark = docs.sparkSession
    base = docs.select(doc_id, text).filter(F.col(text).isNotNull() & (F.col(text) != ""))
    kind = base.schema[doc_id].dataType.simpleString()
    item_kind = items.schema[item_id].dataType.simpleString()
    schema = f"{doc_id} {kind}, {item_id} {item_kind}, sentence_no int, n_covered int, n_equal int"

    def search(part: list[Sentence]) -> DataFrame:
        held = spark.sparkContext.broadcast(Detector(part, rules))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            detector = held.value
            for b in batches:
                rows = []
                for i, t in zip(b[doc_id], b[text]):
                    rows += [(i, item, k, n, e) for (item, k), (n, e) in detector.scan(t).items()]
                yield pd.DataFrame(rows, columns=[doc_id, item_id, "sentence_no", "n_covered", "n_equal"])

        return base.mapInPandas(run, schema)

    out, part, size = [], [], 0
    query = item_sentences(items, item_id, item_text, item_lang, rules)
    for r in query.orderBy("item", "number", "words").toLocalIterator():
        if part and size + len(r.words) > most_tokens:
            out.append(search(part))
            part, size = [], 0
        part.append(Sentence(r.item, r.number, r.words, r.owners, r.peers, r.need, r.cjk))
        size += len(r.words)
    if part:
        out.append(search(part))
    if not out:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, out)
