"""Matching entities of two tables that share no key: soft-logic linkage.

Names are parsed into noisy attributes (brand, subject, number, country).
Candidates come from equality on subject and number and from shared deletion
forms of the folded brand, as many deletions as the least similarity allows, so
no block is compared pairwise beyond that.
Every candidate pair is a variable between 0 and 1.  Weighted rules become
hinge losses:

* similarity: a similar pair should hold, the more so the more similar, an
  unsupported one should not;
* exclusivity: a record of one side belongs to one station, and a source has
  one record per station;
* transitivity: what holds for a station holds for a station that can't be
  told from it.

The convex problem is solved by alternating directions (consensus ADMM), spread
over its connected components; the values are confidences.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.components import components
from airloom.llm.confusables import LOOK_ALIKE, skeleton_of
from airloom.session import cut

# Country names in feeds and their codes.
COUNTRIES = {
    "united kingdom": "UK", "great britain": "UK", "england": "UK", "germany": "DE", "deutschland": "DE", "france": "FR", "spain": "ES",
    "poland": "PL", "russia": "RU", "greece": "GR", "pakistan": "PK", "india": "IN", "south africa": "ZA", "usa": "US",
    "united states": "US", "portugal": "PT", "italy": "IT", "ireland": "IE", "austria": "AT", "switzerland": "CH", "netherlands": "NL",
}
# Picture quality and filler words of channel names.
FILLER = set("hd fhd uhd sd 4k 8k hevc h265 hq raw tv channel".split())
# Numbers as words and Roman numerals.
NUMBERS = {"ii": "2", "iii": "3", "iv": "4", "two": "2", "three": "3", "four": "4", "one": "1"}
# Letters of other alphabets in Latin ones, as feeds transliterate them.
CYRILLIC = dict(zip("абвгдеёжзийклмнопрстуфхцчшщъыьэюя",
                    "a b v g d e e zh z i i k l m n o p r s t u f h ts ch sh sch - y - e iu ia".split()))
GREEK = dict(zip("αβγδεζηθικλμνξοπρστυφχψως", "a v g d e z i th i k l m n ks o p r s t i f h ps o s".split()))
GREEK_PAIRS = {"μπ": "b", "ντ": "d", "γκ": "g", "ου": "u"}

_PREFIX = regex.compile(r"^\s*\|?\s*([A-Za-z]{2})\s*[|:]\s*")
_COUNTRY = regex.compile(r"\(([^)]*)\)")
_DOT = regex.compile(r"\.([A-Za-z]{2})\s*$")
_LAST = regex.compile(r"\s([A-Z]{2})\s*$")
_GLUED = regex.compile(r"(?<=\p{Ll})(?=\p{Lu})|(?<=\p{L}\p{M}?)(?=\d)|(?<=\p{L})(?=\+\d)")
_ALPHABETS = regex.compile(r"[\p{Cyrillic}\p{Greek}]")
_BLANKS = regex.compile(r"[\p{Zs}\s]+")
# "plus 1" is a shift, "Plus 4K" is not
_SHIFT = regex.compile(r"\bplus\s+(?!\d+K\b)(\d)", regex.I)
_NUMBER = regex.compile(r"\+?\d+")


@lru_cache(1 << 16)
def fold(word: str) -> str:
    """Spelling habits levelled: accents, doubled letters, c/k/q, w/v, y/j/i, x/ks."""
    w = "".join(c for c in unicodedata.normalize("NFD", word.lower()) if unicodedata.category(c) != "Mn")
    for a, b in GREEK_PAIRS.items():
        w = w.replace(a, b)
    w = "".join(CYRILLIC.get(c) or GREEK.get(c) or c for c in w).replace("-", "")
    w = w.replace("x", "ks").translate(str.maketrans("cqwyj", "kkvii"))
    out: list[str] = []
    for c in w:
        if not out or out[-1] != c:
            out.append(c)
    return "".join(out)


def plain(name: str) -> str:
    """Look-alike letters back to Latin, except in words that are written in another alphabet."""
    if name.isascii() and name.isprintable():
        return " ".join(name.split())
    words = _BLANKS.sub(" ", name).split(" ")
    foreign = [w for w in words if _ALPHABETS.search(w) and any(_ALPHABETS.match(c) and c not in LOOK_ALIKE for c in w)]
    out = []
    for w in words:
        alphabetic = [c for c in w if c.isalpha()]
        whole = alphabetic and all(_ALPHABETS.match(c) for c in alphabetic)
        if w in foreign and whole or foreign and whole and len(alphabetic) > 3:
            out.append("".join(c for c in unicodedata.normalize("NFKC", w) if unicodedata.category(c) != "Cf"))
        else:
            out.append(unicodedata.normalize("NFC", skeleton_of(w)))
    return " ".join(w for w in out if w)


def split_name(name: str, codes: set[str]) -> tuple[list[str], list[str], str | None]:
    """Words without filler, numbers and country of a name."""
    t, country = plain(name), None
    if (m := _PREFIX.match(t)) and m.group(1).upper() in codes:
        country, t = m.group(1).upper(), t[m.end() :]
    for m in _COUNTRY.finditer(t):
        inside = m.group(1).strip()
        country = COUNTRIES.get(inside.lower()) or (inside.upper() if inside.upper() in codes else country)
    t = _COUNTRY.sub(" ", t)
    if (m := _DOT.search(t)) and m.group(1).upper() in codes:
        country, t = country or m.group(1).upper(), t[: m.start()]
    if (m := _LAST.search(t)) and m.group(1) in codes:
        country, t = country or m.group(1), t[: m.start()]
    t = _SHIFT.sub(r"+\1", _GLUED.sub(" ", t).replace("4 K", "4K"))
    words, numbers = [], []
    for w in t.split():
        w = w.strip("|:.,;-_'\"!()[]")
        low = w.lower()
        if not w or low in FILLER:
            continue
        if _NUMBER.fullmatch(low):
            numbers.append(low)
        elif low in NUMBERS:
            numbers.append(NUMBERS[low])
        else:
            words.append(w)
    if not words:
        words = [w for w in t.split() if w.lower() in FILLER][:1]
    return words, numbers, country


def distance(a: str, b: str, most: int = 3) -> int:
    """Edit distance with neighbour swaps, cut off above ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return last[-1]


class Parser:
    """Assigns brand, subject and number, given the folded subject words of the clean side.

    marks: folded words that tell stations apart as numbers do (North, Plus).
    """

    def __init__(self, subjects: list[str], codes: set[str], marks: list[str] = ()):
        self.subjects, self.codes, self.marks = sorted(set(subjects)), codes, set(marks)
        self.known = set(self.subjects)
        self._memo: dict[str, tuple[float, str]] = {}

    def subject_of(self, w: str) -> tuple[float, str]:
        """Best subject for a folded word with its score."""
        if w in self.known:
            return 1.0, w
        if (hit := self._memo.get(w)) is not None:
            return hit
        best = (0.0, "")
        for s in self.subjects:
            score = 0.0
            if len(w) >= 3 and s.startswith(w):
                score = 0.9 + 0.05 * len(w) / len(s)
            elif len(s) >= 4 and w.startswith(s):
                score = 0.9
            elif len(w) >= 4 and len(s) >= 4:
                d = distance(w, s, 2)
                share = 1 - d / max(len(w), len(s))
                score = share if d <= 2 and share >= 0.66 else 0.0
            best = max(best, (score, s))
        self._memo[w] = best
        return best

    def parse(self, name: str) -> tuple[str, str, str, str | None, float]:
        """(folded brand, subject, number, country, subject score); brand and subject may be empty."""
        words, numbers, country = split_name(name, self.codes)
        folded = [fold(w) for w in words]
        # brand and subject stay: of two words only the last can be a mark
        marks = [i for i, w in enumerate(folded) if w in self.marks and (len(folded) > 2 or i == 1)]
        number = " ".join(sorted({*numbers, *(folded[i] for i in marks)}))
        folded = [w for i, w in enumerate(folded) if i not in marks] or folded
        scored = [self.subject_of(w) for w in folded]
        if len(folded) >= 2:
            at = max(range(len(folded)), key=lambda i: (scored[i][0], i))
            if scored[at][0] > 0:
                return "".join(w for i, w in enumerate(folded) if i != at), scored[at][1], number, country, scored[at][0]
        glued = "".join(folded)
        tails = [s for s in self.subjects if len(glued) - len(s) >= 3 and glued.endswith(s)]
        if tails:
            s = max(tails, key=len)
            return glued[: -len(s)], s, number, country, 0.95
        heads = [s for s in self.subjects if len(glued) - len(s) >= 3 and glued.startswith(s)]
        if heads:
            s = max(heads, key=len)
            return glued[len(s) :], s, number, country, 0.9
        # a shortened or foreign form of a subject at the end of one word
        ends = [(self.subject_of(glued[i:]), i) for i in range(3, len(glued) - 3)]
        ends = [(score, -i, s) for (score, s), i in ends if score >= 0.9]
        if ends:
            score, i, s = max(ends)
            return glued[:-i], s, number, country, score
        return glued, "", number, country, 0.5


def allowed(length: int, least: float) -> int:
    """Edits between two names that keep a similarity of ``least``, given the longer one's length."""
    return math.floor((1 - least) * length + 1e-9)


def block_keys(brand: str, least: float, left: bool, kept: int = 6) -> list[str]:
    """Keys of which any two brands of the two sides with a similarity of ``least`` share one.

    Two names at most k edits apart keep all but k letters in common, in order;
    so their first kept + k letters (filled up at the end) share a form with k
    letters less.  For long names, kept pairs of common letters from the front and
    as many from the back don't overlap, hence one end has k/2 edits at most, and
    the ends share forms with that many letters less.  k depends on the longer
    name, so a key names its length and which side has it: names of other lengths
    don't meet there.
    """
    n, keys, longest = len(brand), set(), len(brand)
    while True:
        k = allowed(longest, least)
        if longest - n > k:
            break
        tags = ("both", "left" if left else "right") if longest == n else ("right" if left else "left",)
        if longest < 12:
            ends, size, lost = [("", brand)], kept, k
        else:
            ends, size, lost = [("<", brand), (">", brand[::-1])], min(kept, (longest - k) // 2), k // 2
        for name, letters in ends:
            for x in {"".join(c) for c in combinations(letters[: size + lost].ljust(size + lost), size)}:
                keys |= {f"{longest} {t}{name} {x}" for t in tags}
        longest += 1
    return sorted(keys)


def similarity(a: str, b: str, least: float = 0.0) -> float:
    """1 less the edits per letter of the longer name; 0 where that is below ``least``."""
    size = max(len(a), len(b), 1)
    most = allowed(size, least)
    d = 0 if a == b else distance(a, b, most)
    return 1 - d / size if d <= most else 0.0


def known_words(names: DataFrame, name: str, codes: set[str], share: float = 0.002) -> tuple[list[str], list[str]]:
    """Folded subject words and marks of the names.

    Both are last words of at least ``share`` of all names, so at most 1/share.  What
    mostly comes after another such word is a mark (North in "Sport North"); the word
    before it then counts as the last.
    """

    def last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for n in b[name]:
                words, _, _ = split_name(n, codes)
                if len(words) >= 2:
                    out.append((fold(words[-1]), fold(words[-2]), len(words)))
            yield pd.DataFrame(out, columns=["w", "before", "size"])

    texts = _spread(names.select(name).filter(f"{name} is not null").distinct())
    words = cut(texts.mapInPandas(last, "w string, before string, size int").groupBy("w", "before", "size").agg(F.count("*").alias("n")), "words")
    total = words.agg(F.sum("n")).first()[0] or 0

    def frequent(counts: DataFrame) -> list[str]:
        return [r.w for r in counts.groupBy("w").agg(F.sum("n").alias("n")).filter(F.col("n") >= share * total).collect() if r.w]

    ends = frequent(words)
    follows = words.filter(F.col("w").isin(ends)).groupBy("w").agg(F.sum(F.when(F.col("before").isin(ends) & (F.col("size") > 2), F.col("n")).otherwise(0)).alias("after"), F.sum("n").alias("n"))
    marks = [r.w for r in follows.filter("2 * after > n").collect()]
    inner = F.col("w").isin(marks) & (F.col("size") > 2)
    return frequent(words.select(F.when(inner, F.col("before")).otherwise(F.col("w")).alias("w"), "n").filter(~F.col("w").isin(marks))), marks


def _spread(rows: DataFrame) -> DataFrame:
    """Rows over as many tasks as a shuffle has, however few bytes they are: Python work counts by rows."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def parsed(rows: DataFrame, name: str, parser: Parser) -> DataFrame:
    """Rows with brand, subject, number, name_country and subject_score of the name."""
    texts = rows.select(F.col(name).alias("text")).filter("text is not null").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [(t, *parser.parse(t)) for t in b["text"]]
            yield pd.DataFrame(got, columns=["text", "brand", "subject", "number", "name_country", "subject_score"])

    schema = "text string, brand string, subject string, number string, name_country string, subject_score double"
    return rows.join(_spread(texts).mapInPandas(run, schema), rows[name] == F.col("text")).drop("text")


def brand_pairs(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """Columns brand, other, brand_sim for all brands of the two sides with a similarity of ``least``.

    Pairs that share a key are first held against the built-in edit distance, which
    counts a neighbour swap as two edits: above twice the allowed number no pair is
    similar.  Only the rest is compared in Python.
    """

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            t = t.assign(brand_sim=[similarity(x, y, least) for x, y in zip(t["brand"], t["other"])])
            yield t[t["brand_sim"] >= least]

    def keys(side: DataFrame, is_left: bool) -> DataFrame:
        def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = [(x, v) for x in b["brand"] for v in block_keys(x, least, is_left)]
                yield pd.DataFrame(out, columns=["brand", "v"])

        spelt = _spread(side.select("brand").distinct()).mapInPandas(spell, "brand string, v string")
        # equal hashes of different keys only add pairs that the comparison drops
        return spelt.select("brand", F.xxhash64("v").alias("v"))

    pairs = keys(left, True).hint("shuffle_merge").join(keys(right, False).withColumnRenamed("brand", "other"), "v")
    edits = F.floor((1 - least) * F.greatest(F.length("brand"), F.length("other")) + 1e-9).cast("int")
    near = pairs.filter((F.abs(F.length("brand") - F.length("other")) <= edits) & (F.levenshtein("brand", "other") <= 2 * edits))
    near = near.select("brand", "other").distinct()
    return cut(_spread(near).mapInPandas(compare, "brand string, other string, brand_sim double"), "brands")


def further_edits(brands: DataFrame, stations: DataFrame, at_least: int = 3) -> DataFrame:
    """brands with ``further``: how many edits more than the nearest established brand a pair needs.

    Established are brands of ``at_least`` stations, which a slip of the pen rarely has.
    A name spelled as one brand is hardly another one misspelled.
    """
    edits = F.round((1 - F.col("brand_sim")) * F.greatest(F.length("brand"), F.length("other")))
    known = stations.groupBy("brand").agg(F.countDistinct("station").alias("n")).filter(F.col("n") >= at_least).select("brand")
    nearest = brands.join(known, "brand", "left_semi").groupBy("other").agg(F.min(edits).alias("nearest"))
    further = F.greatest(F.lit(0.0), edits - F.coalesce("nearest", edits))
    return brands.join(nearest, "other", "left").withColumn("further", further).drop("nearest")


class NoConvergence(RuntimeError):
    pass


def admm(rule: np.ndarray, var: np.ndarray, coef: np.ndarray, weight: np.ndarray, constant: np.ndarray, *, rho: float, tol: float, max_rounds: int) -> np.ndarray:
    """Values of the variables 0..n-1 of one block of whole components; weight and constant by rule, the rest by term."""
    norm, degree = np.bincount(rule, coef * coef), np.bincount(var)
    u, z = np.zeros(len(coef)), np.full(len(degree), 0.5)
    for _ in range(max_rounds):
        d = np.bincount(rule, coef * (z[var] - u)) + constant
        # the step along the coefficients: none, full, or up to the hinge
        x = z[var] - u - np.where(d <= 0, 0.0, np.minimum(weight / rho, d / norm))[rule] * coef
        mean = np.clip(np.bincount(var, x + u) / degree, 0.0, 1.0)
        moved, apart = np.abs(mean - z).max(), np.abs(x - mean[var]).max()
        u, z = u + x - mean[var], mean
        if max(moved, apart) < tol:
            return z
    raise NoConvergence(f"residuals {apart:.2g}, {moved:.2g} after {max_rounds} rounds")


def _solve_here(rows: DataFrame, rho: float, tol: float, max_rounds: int, batch: int = 200_000) -> DataFrame:
    """Components solved where they are: rows with root, rule, var, coef, weight, constant -> var, y."""
    kind = rows.schema["var"].dataType.simpleString()

    def solved(t: pd.DataFrame) -> pd.DataFrame:
        rule, first = pd.factorize(t["rule"])[0], ~t["rule"].duplicated().to_numpy()
        var, names = pd.factorize(t["var"])
        y = admm(rule, var, t["coef"].to_numpy(), t["weight"].to_numpy()[first], t["constant"].to_numpy()[first], rho=rho, tol=tol, max_rounds=max_rounds)
        return pd.DataFrame({"var": names, "y": y})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for b in batches:
            held = b if held is None else pd.concat([held, b], ignore_index=True)
            if len(held) >= batch:
                # the last component may go on in the next batch
                last = held["root"] == held["root"].iloc[-1]
                if not last.all():
                    yield solved(held[~last].reset_index(drop=True))
                    held = held[last].reset_index(drop=True)
        if held is not None and len(held):
            yield solved(held)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "root").sortWithinPartitions("root", "rule").mapInPandas(run, f"var {kind}, y double")


def _solve_rounds(rows: DataFrame, rho: float, tol: float, max_rounds: int) -> DataFrame:
    """The same updates as joins and aggregations, a round each, for components of any size."""
    copies = cut(rows.withColumn("u", F.lit(0.0)).withColumn("z", F.lit(0.5)), "copies")
    norm = F.sum(F.col("coef") * F.col("coef"))
    for _ in range(max_rounds):
        d = F.sum(F.col("coef") * (F.col("z") - F.col("u"))) + F.first("constant")
        step = F.when(d <= 0, 0.0).otherwise(F.least(F.first("weight") / rho, d / norm))
        moved = copies.join(copies.groupBy("rule").agg(step.alias("step")), "rule").withColumn("x", F.col("z") - F.col("u") - F.col("step") * F.col("coef"))
        mean = moved.groupBy("var").agg(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.avg(F.col("x") + F.col("u")))).alias("zn"))
        gap = F.greatest(F.abs(F.col("x") - F.col("zn")), F.abs(F.col("zn") - F.col("z"))).alias("gap")
        now = moved.join(mean, "var").select("rule", "var", "coef", "weight", "constant", (F.col("u") + F.col("x") - F.col("zn")).alias("u"), F.col("zn").alias("z"), gap)
        copies = cut(now, "copies")
        if (copies.agg(F.max("gap")).first()[0] or 0.0) < tol:
            return copies.groupBy("var").agg(F.first("z").alias("y"))
    raise NoConvergence(f"no fixed point after {max_rounds} rounds")


def solve(terms: DataFrame, potentials: DataFrame, *, rho: float = 2.0, tol: float = 1e-3, max_rounds: int = 5000, most_terms: int = 500_000) -> DataFrame:
    """Minimise the sum of weight * max(0, coefficients . y + constant) over 0 <= y <= 1.

    terms: rule, var (long), coef.  potentials: rule, weight, constant.  Result:
    var, y.  Consensus ADMM: each rule moves its own copies of the variables
    (closed form), each variable averages its copies, until no copy is further than
    ``tol`` from its variable and no variable moves by more.  ``max_rounds`` is a
    guard that raises.  Variables that no rule joins are independent problems, so
    connected components are solved side by side, many in one task; a component of
    more than ``most_terms`` terms is solved by the same updates over DataFrames.
    """
    rows = cut(terms.join(potentials, "rule"), "terms")
    joint = rows.groupBy("rule").agg(F.min("var").alias("a"), F.max("var").alias("z")).filter("a <> z").select("rule", "a")
    edges = rows.select("rule", "var").join(joint, "rule").select("a", F.col("var").alias("b"))
    root = components(edges).select(F.col("node").alias("var"), "root")
    rows = cut(rows.join(root, "var", "left").withColumn("root", F.coalesce("root", "var")), "rooted")
    large = rows.groupBy("root").agg(F.count("*").alias("n")).filter(F.col("n") > most_terms).select("root")
    if large.isEmpty():
        return _solve_here(rows, rho, tol, max_rounds)
    far = _solve_rounds(rows.join(large, "root", "left_semi").drop("root"), rho, tol, max_rounds)
    return _solve_here(rows.join(large, "root", "left_anti"), rho, tol, max_rounds).union(far)


def link(
    stations: DataFrame, records: DataFrame, *, least_brand: float = 0.7,
    w_similar: float = 1.0, w_prior: float = 0.35, w_exclusive: float = 4.0, w_transitive: float = 0.5, idle: bool = True,
) -> DataFrame:
    """Confidence of each candidate (station, record).

    stations: station (id), brand, subject, number, country (NULL if unknown).
    records: source, record (id), brand, subject, number, country (NULL if
    unknown), countries (list of possible ones, NULL if any), subject_score.  A
    record may have several rows (names); its best name counts.  Result: station,
    source, record, confidence.  ``idle``: also candidates whose brands rule out any
    confidence but 0, which are most.
    """
    def part(brand):
        return 0.55 * brand * F.pow(F.lit(0.5), "further")

    def slope(s):
        """Weight of a claim.  Without a slope the optimum could share a record between any claims, however unequal."""
        return w_similar * F.greatest(F.lit(0.0), F.least(F.lit(1.0), (s - 0.6) / 0.4))

    brands = further_edits(brand_pairs(stations, records, least_brand), stations)
    if not idle:
        # the best that subject and place could add
        brands = brands.filter(slope(part(F.col("brand_sim")) + 0.45) > w_prior)
    r = records.select("source", "record", F.col("brand").alias("other"), "subject", "number", F.col("country").alias("rc"), "countries", "subject_score")
    fits = F.col("country").isNull() | F.when(F.col("rc").isNotNull(), F.col("rc") == F.col("country")).otherwise(
        F.col("countries").isNull() | F.array_contains("countries", F.col("country"))
    )
    known = F.col("rc").isNotNull() & F.col("country").isNotNull()
    only = F.coalesce(F.size("countries") == 1, F.lit(False)) & F.col("country").isNotNull()
    place = F.when(known, 1.0).when(only, 0.95).otherwise(0.75)
    pairs = stations.join(brands, "brand").join(r, ["other", "subject", "number"]).filter(fits)
    score = part(F.col("brand_sim")) + 0.15 * F.col("subject_score") + 0.3 * place
    pairs = pairs.groupBy("station", "source", "record").agg(F.max(score).alias("s"), F.first("brand").alias("brand"), F.first("subject").alias("subject"), F.first("number").alias("number"), F.first("country").alias("country"))
    every = cut(pairs.withColumn("var", F.monotonically_increasing_id()).withColumn("weight", slope(F.col("s"))), "pairs")
    # a claim that weighs no more than the prior is 0 in the optimum: all other rules press it down, but for a station without country, which follows
    pairs, still = every.filter(f"weight > {w_prior} or country is null"), every.filter(f"weight <= {w_prior} and country is not null")
    out = ["station", "source", "record", "confidence", "s"]

    def rule(kind: str, *keys: str):
        """The rule's name, from the values it is about."""
        return F.concat_ws("\x01", F.lit(kind), *[F.col(k).cast("string") for k in keys])

    # how much the pair's similarity speaks for it; scores below the base speak against it
    want = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("s") - 0.6) / 0.3))
    one = pairs.select("var", want.alias("want"), "weight")
    similar = one.select(rule("s", "var").alias("rule"), "var", F.lit(-1.0).alias("coef"), "weight", F.col("want").alias("constant"))
    prior = one.select(rule("p", "var").alias("rule"), "var", F.lit(1.0).alias("coef"), F.lit(w_prior).alias("weight"), F.lit(0.0).alias("constant"))
    of_record = pairs.filter("country is not null").select(rule("r", "source", "record").alias("rule"), "var", F.lit(1.0).alias("coef"))
    of_source = pairs.select(rule("t", "station", "source").alias("rule"), "var", F.lit(1.0).alias("coef"))
    groups = of_record.union(of_source)
    shared = groups.groupBy("rule").agg(F.count("*").alias("n")).filter("n > 1").select("rule", F.lit(w_exclusive).alias("weight"), F.lit(-1.0).alias("constant"))
    # a station of unknown country follows the same station of a known one
    a = pairs.filter("country is not null").select("source", "record", "brand", "subject", "number", F.col("var").alias("v1"))
    b = pairs.filter("country is null").select("source", "record", "brand", "subject", "number", F.col("var").alias("v2"))
    follow = a.join(b, ["source", "record", "brand", "subject", "number"]).select(rule("f", "v1", "v2").alias("rule"), "v1", "v2")
    follow_terms = follow.select("rule", F.col("v1").alias("var"), F.lit(1.0).alias("coef")).union(follow.select("rule", F.col("v2").alias("var"), F.lit(-1.0).alias("coef")))
    terms = similar.select("rule", "var", "coef").union(prior.select("rule", "var", "coef")).union(groups.join(shared.select("rule"), "rule")).union(follow_terms)
    potentials = (
        similar.select("rule", "weight", "constant").union(prior.select("rule", "weight", "constant")).union(shared)
        .union(follow.select("rule", F.lit(w_transitive), F.lit(0.0)))
    )
    y = solve(terms, potentials.dropDuplicates(["rule"]))
    return pairs.join(y, "var").withColumnRenamed("y", "confidence").select(*out).union(still.withColumn("confidence", F.lit(0.0)).select(*out))
