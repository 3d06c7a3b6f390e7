"""Sentence units across languages and scripts.

A text is read as lexemes (words, blanks, stops, quotes).  Boundary rules are a
deterministic transducer over lexeme classes: its table is compiled once, its
states say whether a stop is pending and what followed it.  A long document is
processed as chunks: every chunk yields its state-transition function (start
state -> end state), the functions are composed by a parallel prefix scan (up
over blocks of chunks, across, down again), and then each chunk emits its boundaries from its true start state,
independently of the others.  Short documents are a single chunk.

Fixed lists of abbreviations are per language; ``auto`` class decisions (digits
before a stop, case of the next word) need no list.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.operators.sequence import running
from airloom.session import cut

CHUNK = 20_000

# Abbreviations never followed by a boundary (titles, units before a name).
TITLES = set(
    "mr mrs ms dr prof st sr sra srta dra dres mme mlle mm ph.d m.in i.e e.g vs no nr pt godz bzw ca z.b d.h "
    "mio mrd approx aprox ep cap chap p pp ex vol fig art tj np ul al im ks o.a jr rev gen col lt sgt capt hon "
    "д-р г-н г-жа проф им ул тов акад δρ κ κα κ.κ δηλ εκατ δισ π.χ λ.χ αρ σελ κεφ د أ م डॉ श्री प्रो सं u.k u.s"
    " bl str tel abs hrsg inkl zzgl bd hl sog vgl evtl ggf s.o s.u cf env av bd pág págs núm tel avda ed eds fl зам рис табл стр"
    .split()
)
# Abbreviations after which a capital letter begins a new sentence.
OPEN_ENDS = set(
    "etc usw usf itd itp p.m a.m μ.μ π.μ bm br r г гг в вв мин сек час др пр т.д т.п млн млрд тыс jan feb mar apr jun jul aug sep sept oct nov dec u.s.a inc ltd co corp"
    .split()
)
# French and other month abbreviations, followed by names as well.
MONTHS_INSIDE = set("janv févr avr juil".split())
# Abbreviations that a number follows; a capital letter after them begins a sentence.
BEFORE_NUMBER = set("ep cap chap approx aprox nr no vol fig art αρ σελ".split())
# Words that open a time phrase at the start of a sentence.
LEAD_WORDS = set("so at by until from around before after".split())

_CJK = r"\p{Han}\p{Hiragana}\p{Katakana}ー"
LEXEME = regex.compile(
    # a run of words amid a sentence, up to its last word; it can't hold a boundary
    r"(?P<plain>(?<=[\p{L}\p{M}--\p{Thai}] |, )(?:[\p{L}\p{M}--\p{Thai}]++,? ){2,}(?=[\p{L}--\p{Thai}]))"
    rf"|(?P<space> +(?=\S))|(?P<cjk>[{_CJK}]+)|(?P<thai>\p{{Thai}}+)"
    r"|(?P<word>[\p{L}\p{M}\p{N}](?:[\p{L}\p{M}\p{N}'’&\-]++|[.,:](?=[\p{N}])(?<=[\p{N}][.,:])|(?<=\p{L})\.(?=\p{L}))*)"
    r"|(?P<blank>[^\S\n]*\n[^\S\n]*\n\s*)|(?P<space>\s+)"
    r"|(?P<cjkstop>[。！？｡]+)|(?P<danda>[।॥۔؟]+)|(?P<dots>\.{2,}|…+)|(?P<stop>[.!?;]+(?:(?<=;)|[.!?]*))"
    r"|(?P<quote>[\"“”‘’„‟«»‹›])|(?P<close>[』」》）\)\]]+)|(?P<open>[「『《（\(\[¿¡]+)|(?P<other>.)",
    regex.S | regex.V1,
)


# The same lexemes for texts in alphabets with case and without combining marks, in a faster engine.
_OTHER_SCRIPTS = re.compile("[\u0300-\u036f\u0483-\u0489\u0590-\u1dff\u2c00-\ud7ff\uf900-\uffff\U00010000-\U0010ffff]")
_CASED = re.compile(
    r"(?P<plain>(?:(?<=[^\W\d_] )|(?<=, ))(?:[^\W\d_]+,? ){2,}(?=[^\W\d_]))"
    r"|(?P<word>[^\W_](?:[^\W_]+|['’&\-]|[.,:](?=\d)(?<=\d[.,:])|(?<=[^\W\d_])\.(?=[^\W\d_]))*)"
    r"|(?P<blank>[^\S\n]*\n[^\S\n]*\n\s*)|(?P<space>\s+)|(?P<dots>\.{2,}|…+)|(?P<stop>[.!?;]+(?:(?<=;)|[.!?]*))"
    r"|(?P<quote>[\"“”‘’„‟«»‹›])|(?P<close>[)\]]+)|(?P<open>[(\[¿¡]+)|(?P<other>.)",
    re.S,
)


class Transducer:
    """States and the compiled table (state, class) -> (state, action).

    Actions: 0 nothing, 1 boundary before this lexeme (the sentence ended at the
    last closing mark).  ``START`` is before a sentence; ``LEAD`` is inside one
    whose words so far are a time phrase; ``BODY`` inside; ``STOP``/``SOFT``/``QUOTE``
    wait for what follows a stop, an abbreviation or a closing quote.
    """

    START, LEAD, BODY, STOP, SOFT, QUOTE, HARD, BANG, THAI = range(9)
    N = 9
    # lexeme classes
    (BLANK, SPACE, NEWSTOP, FULLSTOP, SOFTSTOP, DOTS, CLOSE, OPEN, UPPER, LOWER, DIGIT, CASELESS, CJK, CJKSTOP, BANGSTOP, LEADWORD, TIMEABBR, THAIWORD, THAISPACE, OTHER, LEADLOW, PLAIN) = range(22)
    CLASSES = 22

    def __init__(self) -> None:
        t = self
        table = [[(s, 0)] * t.CLASSES for s in range(t.N)]

        def put(states, classes, target, action=0):
            for s in states:
                for c in classes:
                    table[s][c] = (target, action)

        every = range(t.N)
        inside = (t.LEAD, t.BODY)
        waiting = (t.STOP, t.SOFT, t.QUOTE, t.HARD, t.BANG)
        text = (t.UPPER, t.LOWER, t.DIGIT, t.CASELESS, t.CJK, t.OPEN, t.OTHER, t.CLOSE, t.LEADWORD, t.TIMEABBR, t.THAIWORD)
        put(every, [t.BLANK], t.START, 1)
        put([t.START], [t.BLANK], t.START)
        put([t.START], text, t.BODY)
        put([t.START], [t.LEADWORD], t.LEAD)
        put([t.START], [t.SPACE], t.START)
        put([t.LEAD], [t.UPPER, t.LOWER, t.CASELESS, t.CJK, t.OPEN, t.OTHER, t.CLOSE], t.BODY)
        stops = {t.FULLSTOP: t.STOP, t.SOFTSTOP: t.SOFT, t.DOTS: t.SOFT, t.CJKSTOP: t.HARD, t.BANGSTOP: t.BANG, t.NEWSTOP: t.HARD}
        for c, s in stops.items():
            put(every, [c], s)
        put([t.START], [t.SOFTSTOP, t.DOTS], t.BODY)
        # a.m. and p.m. belong to a time phrase at the start, else they may end a sentence
        put([t.LEAD], [t.TIMEABBR], t.LEAD)
        put([t.BODY, *waiting], [t.TIMEABBR], t.SOFT)
        # what follows a pending stop
        put([t.STOP], [t.UPPER, t.LOWER, t.DIGIT, t.CASELESS, t.CJK, t.OPEN, t.OTHER, t.THAIWORD], t.BODY, 1)
        put([t.HARD], [t.UPPER, t.LOWER, t.DIGIT, t.CASELESS, t.CJK, t.OPEN, t.OTHER, t.THAIWORD], t.BODY, 1)
        put([t.STOP, t.HARD], [t.LEADWORD], t.LEAD, 1)
        put([t.SOFT, t.BANG, t.QUOTE], [t.UPPER, t.OPEN], t.BODY, 1)
        put([t.BANG], [t.DIGIT, t.CASELESS, t.CJK], t.BODY, 1)
        put([t.SOFT, t.BANG, t.QUOTE], [t.LEADWORD], t.LEAD, 1)
        put([t.SOFT, t.QUOTE], [t.LOWER, t.DIGIT, t.CASELESS, t.CJK, t.OTHER, t.THAIWORD], t.BODY)
        put([t.BANG], [t.LOWER, t.OTHER, t.THAIWORD], t.BODY)
        # closing marks after a stop belong to the sentence, and make a reporting clause possible
        put([t.STOP, t.HARD, t.BANG, t.SOFT], [t.CLOSE], t.QUOTE)
        put([t.QUOTE], [t.CLOSE], t.QUOTE)
        put(inside, [t.CLOSE], t.BODY)
        # Thai: a blank between Thai words ends a sentence
        put([t.START], [t.THAIWORD], t.BODY)
        put([t.BODY, t.LEAD], [t.THAISPACE], t.THAI)
        put(waiting, [t.THAISPACE], t.THAI)
        put([t.THAI], [t.SPACE, t.THAISPACE], t.THAI)
        put([t.THAI], [t.THAIWORD, t.OPEN, t.UPPER, t.LOWER, t.CASELESS, t.CJK, t.DIGIT, t.OTHER, t.CLOSE], t.BODY, 1)
        put([t.THAI], [t.LEADWORD], t.LEAD, 1)
        put([t.START], [t.THAISPACE], t.START)
        for i, row in enumerate(table):
            row[t.PLAIN] = row[t.LOWER]
            row[t.LEADLOW] = (t.LEAD, 0) if i in (t.LEAD, t.START) else row[t.LOWER]
        self.table = table
        self.columns = [[row[k][0] for row in table] for k in range(t.CLASSES)]

    def classes(self, text: str, lang: str) -> list[tuple[int, int, int]]:
        """(class, from, to) of every lexeme; context is at most one lexeme on either side."""
        lexer = LEXEME if _OTHER_SCRIPTS.search(text) else _CASED
        lex = [(m.lastgroup, *m.span()) for m in lexer.finditer(text)]
        out = []
        n = len(lex)
        for i, (kind, a, b) in enumerate(lex):
            if kind == "word":
                c = text[a]
                if c.isdigit():
                    k = self.DIGIT
                elif c.isupper() or c.istitle():
                    k = self.LEADWORD if text[a:b].lower() in LEAD_WORDS and not text[a:b].isupper() else self.UPPER
                elif c.islower():
                    k = self.LOWER
                else:
                    k = self.CASELESS
                if k == self.LOWER and text[a:b] in LEAD_WORDS:
                    k = self.LEADLOW
                elif k == self.LOWER and text[a:b] in ("a.m", "p.m"):
                    k = self.DIGIT
            elif kind == "quote":
                blank_before = i == 0 or lex[i - 1][0] in ("space", "blank", "open")
                blank_after = i == n - 1 or lex[i + 1][0] in ("space", "blank")
                opens = text[a] in "“„‟«‹‘" if blank_before == blank_after else blank_before
                if i and lex[i - 1][0] in ("stop", "danda", "cjkstop", "dots") and not blank_before:
                    opens = False
                k = self.OPEN if opens else self.CLOSE
            elif kind == "space":
                k = self.SPACE
                if 0 < i < n - 1 and (lex[i - 1][0] in ("thai", "close") and lex[i + 1][0] in ("thai", "open")) and (lex[i - 1][0] == "thai" or lex[i + 1][0] == "thai"):
                    k = self.THAISPACE
            elif kind == "stop":
                k = self._stop(text, lex, i, lang)
            else:
                k = _KIND[kind]
            out.append((k, a, b))
        return out

    def _stop(self, text: str, lex: list, i: int, lang: str) -> int:
        kind, a, b = lex[i]
        mark = text[a:b]
        before = lex[i - 1] if i else ("", 0, 0)
        after = lex[i + 1] if i + 1 < len(lex) else ("", b, b)
        nxt = lex[i + 2] if after[0] == "space" and i + 2 < len(lex) else after
        if mark == ";":
            greek = before[0] in ("word", "close", "quote") and _last_script(text[before[1] : before[2]]) == "Greek"
            return self.FULLSTOP if (lang == "el" or greek) and after[0] in ("", "space", "blank", "close", "quote") else self.OTHER
        if nxt[0] == "stop" and after[0] == "space":
            return self.OTHER  # a stop that another one follows after a blank
        if after[0] == "space" and nxt[0] == "quote" and text[nxt[1]] in "»”" and (lex[i + 3][0] in ("space", "blank", "stop") if i + 3 < len(lex) else True):
            return self.BANGSTOP
        if after[0] not in ("", "space", "blank", "close", "quote"):
            if "!" in mark or "?" in mark:
                return self.BANGSTOP if after[0] in ("open",) else self.OTHER
            return self.OTHER
        w = text[before[1] : before[2]] if before[0] == "word" else ""
        if "?" in mark:
            return self.FULLSTOP
        if "!" in mark:
            if mark.endswith("."):
                return self.FULLSTOP
            # a name may end with the mark; in scripts without case only a mark after that script ends a sentence
            if nxt[0] == "word" and text[nxt[1]].isalpha() and not text[nxt[1]].isupper() and not text[nxt[1]].islower():
                return self.FULLSTOP if w and not w[-1].isascii() and _last_script(w) == _last_script(text[nxt[1]]) else self.OTHER
            return self.BANGSTOP
        if before[0] != "word":
            return self.FULLSTOP
        low = w.lower()
        if len(w) == 1 and w.isupper():
            return self.OTHER  # an initial
        if low in MONTHS_INSIDE or low in TITLES and low not in OPEN_ENDS and (low not in BEFORE_NUMBER or w != low):
            return self.OTHER if nxt[0] in ("word", "open", "cjk", "thai") else self.FULLSTOP
        if low in BEFORE_NUMBER and w == low:
            return self.SOFTSTOP
        if low in ("a.m", "p.m", "am", "pm"):
            return self.TIMEABBR
        if low in OPEN_ENDS:
            return self.SOFTSTOP
        if w.isdigit() and len(w) <= 2 and lang == "de" and nxt[0] == "word":
            return self.OTHER  # an ordinal
        if len(w) == 1 and w.isalpha():
            # an initial, or part of an abbreviation in several words
            return self.OTHER if w.isupper() or (w != "д" and w != "п" and w != "r") else self.SOFTSTOP
        if "." in w and not w[0].isdigit():
            return self.SOFTSTOP
        return self.FULLSTOP

    def run(self, lexemes: list, state: int, spans: list | None, begin: int, last: int, base: int) -> tuple[int, int, int]:
        """Feed lexemes; spans gets (from, to); begin and last carry the open sentence."""
        table = self.table
        blanks = (self.BLANK, self.SPACE, self.THAISPACE)
        for k, a, b in lexemes:
            state, action = table[state][k]
            if action and spans is not None and begin >= 0:
                spans.append((begin, last))
                begin = -1
            if k not in blanks:
                if begin < 0:
                    begin = base + a
                last = base + b
        return state, begin, last

    def function(self, lexemes: list) -> list[int]:
        """End state for each start state; equal states merge, so most chunks need one pass."""
        columns, now = self.columns, list(range(self.N))
        for i, (k, _, _) in enumerate(lexemes):
            column = columns[k]
            now = [column[s] for s in now]
            if i % 8 == 7 and min(now) == max(now):
                state = now[0]
                for k, _, _ in lexemes[i + 1 :]:
                    state = columns[k][state]
                return [state] * self.N
        return now


_KIND = {
    "plain": Transducer.PLAIN, "blank": Transducer.BLANK, "cjkstop": Transducer.CJKSTOP, "danda": Transducer.NEWSTOP, "dots": Transducer.DOTS,
    "close": Transducer.CLOSE, "open": Transducer.OPEN, "cjk": Transducer.CJK, "thai": Transducer.THAIWORD, "other": Transducer.OTHER,
}
_SCRIPTS = [(s, regex.compile(rf"\p{{{s}}}")) for s in ("Latin", "Greek", "Cyrillic", "Arabic", "Devanagari", "Thai", "Han")]
_MACHINE = Transducer()


def _last_script(w: str) -> str:
    for c in reversed(w):
        for name, p in _SCRIPTS:
            if p.match(c):
                return name
    return ""


_GERMAN = regex.compile(r"\b(?:der|die|das|und|auf|von|ist|nicht|ein|mit|um)\b")
_ROMANCE = regex.compile(r"\b(?:the|of|and|le|la|les|el|los|do|da|em|na|w|z|się|de|du|il|en)\b")


def guess_language(text: str, lang: str | None) -> str:
    """The given language, or German where its function words prevail in the whole text."""
    if lang:
        return lang.strip().lower()[:2]
    return "de" if sum(1 for _ in _GERMAN.finditer(text)) > sum(1 for _ in _ROMANCE.finditer(text)) else ""


def sentences_of(text: str, lang: str | None = None) -> list[tuple[int, int]]:
    """Half-open ranges of the sentences of one text, without blanks around them."""
    spans: list[tuple[int, int]] = []
    m = _MACHINE
    _, begin, last = m.run(m.classes(text, guess_language(text, lang)), m.START, spans, -1, 0, 0)
    if begin >= 0:
        spans.append((begin, last))
    return spans


_SAFE_CUTS = regex.compile(
    # before a blank between two ordinary words, and before an empty line
    r"(?<=[\p{L}--\p{Thai}])(?= [\p{L}--\p{Thai}])|(?<=\S)(?=[^\S\n]*\n[^\S\n]*\n)"
    # after a full stop of CJK, and amid a run of CJK or Thai letters that doesn't belong to another word
    rf"|(?<=[。！？])(?=[{_CJK}])|(?<=(?:\A|[^\p{{L}}\p{{M}}\p{{N}}'’&\-.,:])[{_CJK}]{{1,2000}})(?=[{_CJK}])"
    r"|(?<=(?:\A|[^\p{L}\p{M}\p{N}'’&\-.,:])\p{Thai}{1,2000})(?=\p{Thai})",
    regex.V1,
)


def _cuts(text: str, size: int) -> list[int]:
    """Chunk starts, each at a place where lexemes and their context are the same on either side as in the whole text.

    A run of such lexemes leads to the same state as one of them.  A stretch that
    has no such place (one word, or figures and marks without an empty line) stays whole.
    """
    starts, at = [0], 0
    while len(text) - at > size:
        m = _SAFE_CUTS.search(text, at + size)
        if not m or m.start() <= at or m.start() == len(text):
            break
        at = m.start()
        starts.append(at)
    return starts


def _short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        ids, lo, hi = [], [], []
        for i, text, lang in zip(b["id"], b["text"], b["lang"]):
            for a, z in sentences_of(text, lang):
                ids.append(i)
                lo.append(a)
                hi.append(z)
        yield pd.DataFrame({"id": ids, "sent_from": lo, "sent_to": hi})


def _chunks(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for i, text, lang in zip(b["id"], b["text"], b["lang"]):
            lang = guess_language(text, lang)
            starts = [*_cuts(text, size), len(text)]
            rows += [(i, n, starts[n], text[starts[n] : starts[n + 1]], lang) for n in range(len(starts) - 1)]
        yield pd.DataFrame(rows, columns=["id", "n", "base", "part", "lang"])


def _functions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    m = _MACHINE
    for b in batches:
        f = [m.function(m.classes(t, lang)) for t, lang in zip(b["part"], b["lang"])]
        yield pd.DataFrame({"id": b["id"], "n": b["n"], "f": f})


def _emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spans of each chunk; a span at a chunk's edge is marked open on that side."""
    m = _MACHINE
    for b in batches:
        rows = []
        for i, n, base, part, lang, state in zip(b["id"], b["n"], b["base"], b["part"], b["lang"], b["state"]):
            spans: list[tuple[int, int]] = []
            lexemes = m.classes(part, lang)
            first = next((k for k, _, _ in lexemes if k not in (m.BLANK, m.SPACE, m.THAISPACE)), None)
            head = _begins(m, lexemes, int(state))
            _, begin, last = m.run(lexemes, int(state), spans, -1, 0, int(base))
            if begin >= 0:
                spans.append((begin, last))
            for j, (a, z) in enumerate(spans):
                rows.append((i, n, a, z, j == 0 and not head and first is not None))
        yield pd.DataFrame(rows, columns=["id", "n", "sent_from", "sent_to", "joined"])


def _begins(m: Transducer, lexemes: list, state: int) -> bool:
    """Whether the first visible lexeme of a chunk begins a sentence."""
    if state == m.START:
        return True
    for k, _, _ in lexemes:
        state, action = m.table[state][k]
        if action:
            return True
        if k not in (m.BLANK, m.SPACE, m.THAISPACE):
            return False
    return True


def _states(items: Column, state: Column) -> Column:
    """Start state of each item (struct with f) when the first one starts in ``state``."""
    zero = F.struct(state.cast("int").alias("s"), F.array().cast("array<int>").alias("out"))
    step = lambda acc, x: F.struct(F.element_at(x["f"], acc["s"] + 1).alias("s"), F.concat(acc["out"], F.array(acc["s"])).alias("out"))
    return F.aggregate(items, zero, step)["out"]


def chunk_states(fs: DataFrame, block: int = 64) -> DataFrame:
    """Prefix scan over the transition functions of each document: columns id, n, state (in which chunk n starts).

    fs: id, n, f.  Up: the functions of every ``block`` chunks are composed into one.
    Across: the composed functions, one per block, are applied in turn.  Down: each
    block hands its start state through its chunks.  A text has at most 2^31
    bytes, hence a bounded number of blocks; work is linear in the chunks.
    """
    blocks = fs.withColumn("g", F.floor(F.col("n") / block)).groupBy("id", "g").agg(F.sort_array(F.collect_list(F.struct("n", "f"))).alias("items"))
    blocks = cut(blocks, "blocks")
    same = F.array(*[F.lit(s) for s in range(Transducer.N)])
    whole = F.aggregate("items", same, lambda acc, x: F.transform(acc, lambda s: F.element_at(x["f"], s + 1)))
    per_doc = blocks.select("id", F.struct("g", whole.alias("f")).alias("b")).groupBy("id").agg(F.sort_array(F.collect_list("b")).alias("bs"))
    begin = per_doc.select("id", F.explode(F.arrays_zip(F.col("bs")["g"].alias("g"), _states(F.col("bs"), F.lit(Transducer.START)).alias("s"))).alias("x"))
    begin = begin.select("id", F.col("x")["g"].alias("g"), F.col("x")["s"].alias("s"))
    inner = blocks.join(begin, ["id", "g"])
    inner = inner.select("id", F.explode(F.arrays_zip(F.col("items")["n"].alias("n"), _states(F.col("items"), F.col("s")).alias("state"))).alias("x"))
    return inner.select("id", F.col("x")["n"].alias("n"), F.col("x")["state"].alias("state"))


def sentences(docs: DataFrame, doc_id: str, text: str, lang: str, *, chunk: int = CHUNK) -> DataFrame:
    """Columns doc_id, sent_from, sent_to for every sentence of every document.

    Offsets count Unicode characters from 0.  NULL, empty and blank texts have
    no sentences; a text without any stop is one.  Repeated rows give repeated
    sentences.  Texts longer than ``chunk`` characters are cut where it is safe and
    processed in parallel; the result is that of the whole text.
    """
    base = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    base = base.filter(F.trim("text") != "")
    kind = base.schema["id"].dataType.simpleString()
    size = F.length("text")
    out = base.filter(size <= chunk).mapInPandas(_short, f"id {kind}, sent_from long, sent_to long")

    # repeated ids stay apart
    long_docs = base.filter(size > chunk).withColumn("id", F.struct(F.col("id"), F.monotonically_increasing_id().alias("u")))
    long_docs = long_docs.select(F.to_json("id").alias("id"), "text", "lang")
    parts = long_docs.mapInPandas(lambda it: _chunks(it, chunk), "id string, n long, base long, part string, lang string")
    parts = cut(parts, "chunks")
    # an explicit number of partitions is kept however few bytes they hold
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fs = parts.repartition(n, "id", "n").mapInPandas(_functions, "id string, n long, f array<int>")
    starts = chunk_states(fs)
    # in turn, not by key: a repartition by the keys of the join would be optimised away
    spans = cut(parts.join(starts, ["id", "n"]).repartition(n).mapInPandas(_emit, "id string, n long, sent_from long, sent_to long, joined boolean"), "spans")
    # a span that continues the one before it in the document takes its start
    fresh = F.when(F.col("joined"), 0).otherwise(1)
    whole = running(spans, ["id"], "sent_from", [], {"g": ("sum", fresh)}, bucket=50 * chunk)
    whole = whole.groupBy("id", "g").agg(F.min("sent_from").alias("sent_from"), F.max("sent_to").alias("sent_to"))
    whole = whole.select(F.from_json("id", f"id {kind}, u long")["id"].alias("id"), "sent_from", "sent_to")
    return out.unionByName(whole).withColumnRenamed("id", doc_id)


