"""Garbled text from wrong character encoding: find it and undo it.

1. Words with non-ASCII characters are counted over all texts.
2. Near-twins: words are joined on what is left when non-ASCII characters are
   stripped (every code page keeps ASCII), each word with the most frequent
   word of its stripped form; words of scripts without any ASCII letter are
   joined on what an inverted damage would make of them.
3. The characters of a pair are aligned run by run, and the transformation
   (written in one encoding, read in another, once or twice) that maps the
   clean run to the damaged one gets a vote.  Transformations with enough
   different witnesses are learned.
4. Learned transformations are inverted on all other words.  A word counts as
   garbled if its restored form is much more usual, judged by character pairs
   of the whole corpus; replacement and control characters always count.

Transformations come from a fixed space: UTF-8 read in one of 21 code pages,
twice UTF-8, or one code page read in another (see ``space``).  The alignment
decides which of them are learned; damage by anything else is not found.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.session import cut

# Code pages in which texts are wrongly read, and old ones in which they may have been written.
READERS = ("cp1252", "latin-1", "iso8859_15", "cp1250", "iso8859_2", "cp1251", "cp1253", "iso8859_7", "cp1254", "cp437", "cp850", "cp852",
           "cp866", "mac_roman", "koi8_r", "koi8_u", "iso8859_5", "gbk", "shift_jis", "big5", "euc_kr")
WRITERS = ("cp1252", "cp1250", "cp1251", "cp1253", "cp437", "cp850", "cp866", "mac_roman", "koi8_r", "iso8859_2", "iso8859_7", "gbk", "shift_jis", "euc_jp", "big5")
TWICE = ("cp1252", "latin-1", "cp1250", "cp1251", "mac_roman", "cp437")
WIDE = {"gbk", "shift_jis", "euc_jp", "big5", "euc_kr"}
BUCKETS = 1 << 18

_WORD = regex.compile(r"[A-Za-z]*[^\x00-\x7f][A-Za-z\u0080-\U0010ffff]*")
_RUN = regex.compile(r"[^\x00-\x7f]+")
_LOST = regex.compile("[�\u0080-\u009f]")
_BETWEEN = regex.compile(r"[A-Za-z][^\x00-\x7f][A-Za-z]")

Step = tuple[str, str]  # written in, read in
Chain = tuple[Step, ...]


def _page(name: str) -> dict[str, int]:
    """Character -> byte; bytes without a character stand for themselves, as lenient readers have it."""
    out = {}
    for b in range(128, 256):
        try:
            out[bytes([b]).decode(name)] = b
        except UnicodeDecodeError:
            out.setdefault(chr(b), b)
    return out


_PAGES = {n: _page(n) for n in {*READERS, *WRITERS} - WIDE}
_BYTES = {n: {b: c for c, b in p.items()} for n, p in _PAGES.items()}


def damage(text: str, chain: Chain) -> str | None:
    """What readers with the wrong code page see; None if the text can't be written so."""
    for written, read in chain:
        try:
            raw = text.encode(written)
            if read in WIDE:
                text = raw.decode(read)
            else:
                page = _BYTES[read]
                text = "".join(chr(b) if b < 128 else page.get(b, chr(b)) for b in raw)
        except (UnicodeError, LookupError):
            return None
    return text


def restore(text: str, chain: Chain) -> str | None:
    """Inverse of ``damage``; None if the text is no image of it."""
    for written, read in reversed(chain):
        try:
            if read in WIDE:
                raw = text.encode(read)
            else:
                page = _PAGES[read]
                raw = bytes([ord(c) if c < "\x80" else page[c] for c in text])
            text = raw.decode(written)
        except (UnicodeError, KeyError):
            return None
    return text


def space() -> list[Chain]:
    """All transformations that are considered."""
    single = [(("utf-8", r),) for r in READERS]
    double = [(("utf-8", a), ("utf-8", b)) for a, b in product(TWICE, TWICE)]
    pages = [((w, r),) for w, r in product(WRITERS, READERS) if w != r and not (w in WIDE and r in WIDE) and r not in WIDE]
    return single + double + pages


def runs(word: str) -> list[str]:
    return _RUN.findall(word)


def _bucket(pair: str) -> int:
    h = 2166136261
    for c in pair:
        h = ((h ^ ord(c)) * 16777619) & 0xFFFFFFFF
    return (h ^ (h >> 15)) & (BUCKETS - 1)


def pairs_of(word: str) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + 2] for i in range(len(w) - 1) if w[i] > "\x7f" or w[i + 1] > "\x7f"]


class Model:
    """Learned transformations and character-pair counts; bounded in size whatever the corpus."""

    def __init__(self, chains: list[Chain], counts: np.ndarray):
        self.chains = chains
        self.level = np.log1p(counts.astype(float))
        self._memo: dict[str, tuple[bool, str | None]] = {}
        self._pair: dict[str, float] = {}

    def usual(self, word: str) -> float:
        """Mean and least log count of the word's pairs with a non-ASCII character, mixed."""
        get, out = self._pair.get, []
        for p in pairs_of(word):
            v = get(p)
            if v is None:
                v = self._pair[p] = float(self.level[_bucket(p)])
            out.append(v)
        return 0.6 * sum(out) / len(out) + 0.4 * min(out) if out else 99.0

    def _candidates(self, word: str) -> Iterator[tuple[int, str, bool]]:
        """Restored forms with their transformation and whether multi-byte validity speaks for them."""
        several = len(_RUN.findall(word)) > 1
        for i, chain in enumerate(self.chains):
            strong = chain[0][0] == "utf-8"
            whole = restore(word, chain)
            if whole is not None:
                if whole != word:
                    yield i, whole, strong
            elif strong and several:  # only some runs may be damaged
                parts = _RUN.sub(lambda m, c=chain: r if (r := restore(m.group(), c)) is not None else m.group(), word)
                if parts != word:
                    yield i, parts, strong

    def judge(self, word: str) -> tuple[bool, dict[int, tuple[float, str]]]:
        """(garbled, gain and restored form by transformation)."""
        if (known := self._memo.get(word)) is not None:
            return known
        lost = bool(_LOST.search(word))
        base, sure = self.usual(word), lost
        forms: dict[int, tuple[float, str]] = {}
        # a short word without letters around it says little about code pages
        enough = sum(c > "\x7f" for c in word) >= 3 or len(word) >= 3 or bool(_BETWEEN.search(word))
        seen = {word}
        front: list[tuple[str, int, int]] = [(word, 0, -1)]
        while front:
            now, depth, via = front.pop()
            for i, cand, strong in self._candidates(now):
                if cand in seen or cand.isascii():
                    continue
                seen.add(cand)
                if strong and depth < 2:
                    front.append((cand, depth + 1, i if via < 0 else via))
                if _LOST.search(cand):
                    continue
                gain = self.usual(cand) - base
                key = i if via < 0 else via
                if gain > forms.get(key, (0.0, ""))[0]:
                    forms[key] = (gain, cand)
                sure = sure or gain > (0.7 if strong else 2.2) and (strong or enough)
        out = (sure, forms)
        if len(word) < 64 and len(self._memo) < 500_000:
            self._memo[word] = out
        return out

    def mend(self, text: str) -> tuple[bool, str | None]:
        """(garbled, text as it was or None where something was lost)."""
        found = [(m.start(), m.end(), m.group(), *self.judge(m.group())) for m in _WORD.finditer(text)]
        if not any(bad for *_, bad, _ in found):
            return False, None
        if "\ufffd" in text:
            return True, None
        # one transformation usually explains the whole text
        vote: Counter = Counter()
        for *_, forms in found:
            for i, (gain, _) in forms.items():
                vote[i] += min(gain, 3.0)
        main = max(vote, key=vote.__getitem__) if vote else -1
        out, at = [], 0
        for a, b, word, bad, forms in found:
            best = forms.get(main) or (max(forms.values()) if bad and forms else None)
            if bad and best is None:
                return True, None
            if best is not None and (bad or main in forms):
                out += [text[at:a], best[1]]
                at = b
        return True, "".join(out) + text[at:]


def word_counts(texts: DataFrame, text: str) -> DataFrame:
    """word, n for all words with a non-ASCII character; repeated texts count once per word and row."""
    has = texts.filter(F.col(text).rlike(r"[^\x00-\x7f]"))
    words = has.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(r"[A-Za-z]*[^\x00-\x7f][A-Za-z\x{80}-\x{10ffff}]*"), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def twins(words: DataFrame, ratio: float = 4.0) -> DataFrame:
    """Rows (word, twin): each rarer word with the most frequent word of its stripped form.

    One representative per stripped form, so a form shared by many words costs one pair a word.
    """
    w = words.withColumn("k", F.concat_ws("|", F.lower(F.regexp_replace("word", r"[^\x00-\x7f]+", "")), F.regexp_replace(F.regexp_replace("word", r"[^\x00-\x7f]+", "~"), "[A-Za-z]+", "a")))
    w = w.filter(F.length(F.regexp_replace("word", r"[^A-Za-z]", "")) >= 2)
    top = w.groupBy("k").agg(F.max_by("word", F.struct("n", "word")).alias("twin"), F.max("n").alias("m"))
    return w.join(top, "k").filter((F.col("m") >= ratio * F.col("n")) & (F.col("word") != F.col("twin"))).select("word", "twin")


def _align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    chains = space()
    memo: dict[tuple[str, str], list[int]] = {}
    for b in batches:
        out = []
        for g, c in zip(b["word"], b["twin"]):
            gs, cs = runs(g), runs(c)
            if len(gs) != len(cs):
                continue
            fit: set[int] | None = None
            for x, y in zip(gs, cs):
                if x == y:
                    continue  # this run is unharmed
                if (hit := memo.get((x, y))) is None:
                    hit = [i for i, ch in enumerate(chains) if damage(y, ch) == x]
                    if len(memo) < 200_000:
                        memo[(x, y)] = hit
                fit = set(hit) if fit is None else fit & set(hit)
            out += [(i, g) for i in fit or ()]
        yield pd.DataFrame(out, columns=["chain", "word"])


def _invert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    chains = space()
    for b in batches:
        out = []
        for g, n in zip(b["word"], b["n"]):
            for i, ch in enumerate(chains):
                r = restore(g, ch)
                if r is not None and r != g and not r.isascii() and not _LOST.search(r):
                    out.append((i, g, n, r))
        yield pd.DataFrame(out, columns=["chain", "word", "n", "twin"])


def learn(words: DataFrame, support: int = 2, ratio: float = 4.0) -> Model:
    """Transformations with at least ``support`` different damaged words, and the pair counts.

    Only votes per transformation (a fixed list) and hashed counts (2^18 numbers) reach the driver.
    """
    spark = words.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    voted = twins(words, ratio).repartition(n).mapInPandas(_align, "chain int, word string")
    # words without ASCII letters: join the inverted form with the words themselves
    bare = words.filter(~F.col("word").rlike("[A-Za-z]{2}"))
    inverted = bare.repartition(n).mapInPandas(_invert, "chain int, word string, n long, twin string")
    known = words.select(F.col("word").alias("twin"), F.col("n").alias("m"))
    found = inverted.join(known, "twin").filter(F.col("m") >= ratio * F.col("n")).select("chain", "word")
    voted = cut(voted.union(found).distinct(), "votes")
    # several transformations may explain a word: it stands for the one with most votes
    total = voted.groupBy("chain").agg(F.count("*").alias("all"))
    own = voted.join(total, "chain").groupBy("word").agg(F.max_by("chain", F.struct("all", -F.col("chain"))).alias("chain"))
    votes = own.groupBy("chain").agg(F.count("*").alias("votes")).collect()
    chains = space()
    learned = [chains[r.chain] for r in sorted(votes, key=lambda r: -r.votes) if r.votes >= support]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for b in batches:
            for w, k in zip(b["word"], b["n"]):
                for p in pairs_of(w):
                    total[_bucket(p)] += k
        yield pd.DataFrame({"bucket": list(total.keys()), "n": list(total.values())}, columns=["bucket", "n"]).astype("int64")

    rows = words.mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(BUCKETS, np.int64)
    counts[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return Model(learned, counts)


def garbled(rows: DataFrame, row_id: str, fields: list[str], *, support: int = 2) -> DataFrame:
    """row_id, field_name, damaged, restored for each garbled field; restored is NULL where something was lost.

    NULL and pure ASCII texts are never garbled; entity codes are left alone;
    repeated rows are reported each; texts are read whole.  Without any twin
    nothing is learned, and only replacement and control characters are found.
    """
    spark = rows.sparkSession
    long = rows.select(row_id, F.explode(F.array(*[
        F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields])).alias("x")).select(row_id, "x.*")
    long = long.filter(F.col("text").rlike(r"[^\x00-\x7f]"))
    words = cut(word_counts(long, "text"), "words")
    model = learn(words, support)
    held = spark.sparkContext.broadcast((model.chains, model.level.astype(np.float32)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chains, level = held.value
        m = Model(chains, np.zeros(0))
        m.level = level
        for b in batches:
            out = []
            for i, f, t in zip(b[row_id], b["field_name"], b["text"]):
                bad, good = m.mend(t)
                if bad:
                    out.append((i, f, t, good))
            yield pd.DataFrame(out, columns=[row_id, "field_name", "damaged", "restored"])

    kind = rows.schema[row_id].dataType.simpleString()
    return long.mapInPandas(run, f"{row_id} {kind}, field_name string, damaged string, restored string")


