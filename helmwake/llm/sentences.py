"""Sentence boundaries across languages and scripts.

The boundary rules are a finite transducer. Its input symbols are places in the
text where something may happen (end marks of any script, quotation marks, blank
lines, spaces in Thai), each classified by a bounded context on both sides. Its
state knows whether the sentence has any word yet, whether a straight quotation is
open, and whether and how a quotation of the East Asian kind is open. The symbols of
a batch are cut into chunks; a chunk is run from every state at once, which gives its
state-transition function, and these functions are composed by a parallel prefix
scan, whatever text a chunk belongs to. With the entry states known, all chunks
run once more and put out their boundaries.

A text of more than LONG_TEXT characters is cut into pieces inside words, where no
symbol can lie. The pieces spread over tasks; each gives its function, these are
composed per text, and the pieces run again from their entry states.

Which words are abbreviations is learned from all documents: their points end a
paragraph far less often than points do. A list of common ones is the seed.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- the transducer -------------------------------------------------------

#: Input symbols.
RESET, PARAGRAPH, WORD, END, END_NUMBER, QUOTE, END_IF_UNQUOTED, OPEN_AFTER_COLON, OPEN, CLOSE, CLOSE_AFTER_END = range(11)
#: Symbols in a chunk whose transition function is composed.
CHUNK = 256
#: Characters of a text beyond which it is cut into pieces of this size, and those a piece sees around it.
LONG_TEXT, AROUND = 1 << 20, 256
#: Learned abbreviations: most of them, letters of one, most of its occurrences without a point, and the odds against chance (natural logarithm).
MOST_LEARNED, LETTERS, WITHOUT_POINT, ODDS = 4096, 5, 0.1, 6.9


def _compile() -> tuple[np.ndarray, np.ndarray]:
    """Next state and output of every (symbol, state).

    A state is words + 2 * quoted + 4 * kind: words is 1 once the sentence has
    more than a list mark; kind is 0 outside East Asian quotations, else 1 after
    a colon, 2 at the start of a sentence, 3 elsewhere.
    """
    to, out = np.zeros((11, 16), np.uint8), np.zeros((11, 16), bool)
    for s in range(16):
        words, quoted, kind = s & 1, s >> 1 & 1, s >> 2
        pack = lambda w, q, k: w | q << 1 | k << 2
        to[PARAGRAPH, s], out[PARAGRAPH, s] = 0, True
        to[WORD, s] = pack(1, quoted, kind)
        ends = kind == 0
        to[END, s], out[END, s] = (pack(0, quoted, 0), True) if ends else (s, False)
        to[END_NUMBER, s], out[END_NUMBER, s] = (pack(0, quoted, 0), True) if ends and words else (s, False)
        to[QUOTE, s] = pack(words, 1 - quoted, kind)
        free = ends and not quoted
        to[END_IF_UNQUOTED, s], out[END_IF_UNQUOTED, s] = (pack(0, quoted, 0), True) if free else (s, False)
        to[OPEN_AFTER_COLON, s] = pack(1, quoted, 1) if kind == 0 else s
        to[OPEN, s] = pack(words, quoted, 3 if words else 2) if kind == 0 else s
        to[CLOSE, s] = pack(1, quoted, 0)
        # a quoted sentence ends the one around it only where that one leads up to it
        to[CLOSE_AFTER_END, s], out[CLOSE_AFTER_END, s] = (pack(0, quoted, 0), True) if kind == 1 else (pack(1, quoted, 0), False)
    return to, out


STEP, OUTPUT = _compile()


def _functions(s: np.ndarray) -> np.ndarray:
    """The state-transition function of each row of symbols."""
    f = np.tile(np.arange(16, dtype=np.uint8), (len(s), 1))
    for j in range(s.shape[1]):
        f = STEP[s[:, j][:, None], f]
    return f


def _scan(f: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition: row i maps the first row's entry to the state after row i."""
    d = 1
    while d < len(f):
        f[d:] = np.take_along_axis(f[d:], f[:-d].copy().astype(np.int64), axis=1)
        d *= 2
    return f


def run(symbols: np.ndarray, chunk: int = CHUNK, entry: int = 0) -> np.ndarray:
    """The transducer's output at each symbol, by composed chunk functions."""
    n = len(symbols)
    if not n:
        return np.zeros(0, bool)
    k = -(-n // chunk)
    # the padding repeats the last symbol; what it puts out is cut off
    s = np.full(k * chunk, symbols[-1], np.uint8)
    s[:n] = symbols
    s = s.reshape(k, chunk)
    state = np.r_[np.uint8(entry), _scan(_functions(s))[:-1, entry]]
    out = np.zeros((k, chunk), bool)
    for j in range(chunk):
        out[:, j] = OUTPUT[s[:, j], state]
        state = STEP[s[:, j], state]
    return out.reshape(-1)[:n]


# ---- the symbols ----------------------------------------------------------

# Abbreviations after which a sentence goes on; the seed of what is learned.
NEVER = frozenset(
    "no nr fig figs sec cf approx est mr ms mrs dr prof capt lt sgt st vs i.e e.g ver v dev vol ch eq min max gen col jr ave "
    "sr sra dra ing pág pag aprox núm env éq mme mlle vgl ff ges ca bzw inkl fr hr abb tab bspw evtl ggf zzgl "
    "p d z n pp art "
    "ок ул д т г рис табл см стр им проф инж напр акад тов гл δρ περ κ σελ αρ डॉ प्रो श्री د أ ص".split()
)
# Months, before which a number with a point is an ordinal.
MONTHS = frozenset("Januar Jänner Februar März April Mai Juni Juli August September Oktober November Dezember".split())

_CJK = r"぀-ヿ㐀-䶿一-鿿豈-﫿ｦ-ﾟ"
_IS_CJK = re.compile(f"[{_CJK}]")
_BLANK = r"(?:\r\n|\r|\n)(?:[^\S\r\n]*(?:\r\n|\r|\n))+"
#: End marks of all scripts, by Unicode's property Sentence_Terminal (which has no semicolon and no ellipsis).
TERMINAL = frozenset(c for c in map(chr, range(0x20000)) if regex.match(r"\p{Sentence_Terminal}", c))
# a character set with members beyond U+FFFF is slow, so these are only tried on such characters
_MARK = "(?:[%s…;\u037e]|(?=[\U00010000-\U0010ffff])[%s])" % tuple(re.escape("".join(sorted(c for c in TERMINAL if (c > "\uffff") == far))) for far in (False, True))
_MARKS = f"{_MARK}+"
#: End marks that stand for themselves: no abbreviation or number has them.
_PLAIN_ENDS = TERMINAL - set(".!?．。！？｡‼‽⁇⁈⁉﹒﹖﹗")
_GUILLEMET = r"(?:(?:\r\n|\s)»(?![^\s.,;:!?)]))?"
# a straight quotation mark behind an East Asian one opens the next sentence
_CLOSERS = rf"(?:[」』”】》〉）]+[)\]}}]*|[\"'»“’)\]}}›][\"'”»“’)\]}}›]*)?{_GUILLEMET}"
_POINTS = re.compile(
    f"(?P<para>{_BLANK})"
    rf"|(?P<mark>{_MARKS})(?P<close>{_CLOSERS})"
    r'|(?P<quote>")'
    rf"|(?P<copen>[「『]|“(?=[{_CJK}])|(?<=[{_CJK}：，。])“)"
    rf"|(?P<cclose>[」』]|(?<=[{_CJK}，、])”|”(?=[{_CJK}，。、]))"
    r"|(?P<thai>(?<=[ก-๏๚๛])\s+(?=[^\s\dๆฯ๐-๙.,;:!?)\]%»”]))"
)
_PARA_AHEAD = re.compile(rf"[^\S\r\n]*{_BLANK}|\s*\Z")
_TOKEN = re.compile(r"[^\s(\[\"'«“„‘¿¡]+\Z")
_RUN = re.compile(r"[^\W\d_]+\Z")
_OPENERS = re.compile(r"(?:[(\[{\"'“„«‘¿¡‹]\s?)+")
_CAMEL = re.compile(r"[a-z]+[A-Z]")
_LETTER = re.compile(r"[^\W\d_]")
_CJK_MARK = re.compile(r"[。！？｡．]")
_CJK_QUOTE = re.compile(r"[」』”]")
_JOINED = re.compile(r"[A-ZÀ-ÞΑ-ΩА-Я][^\W\d_A-Z]|[AI] [a-z]|\d+ [a-z]+ ")
_OPENED = re.compile(r"[\"(“«„]+(?=[A-Z])")


def _kind(text: str, at: int) -> str:
    """What begins at ``at``: upper, lower, camel, digit, other (a script without case), bullet, dash or sign."""
    c = text[at]
    if c in "•*▪‣◦":
        return "bullet"
    if c in "-–—":
        return "dash"
    m = _OPENERS.match(text, at)
    at = m.end() if m else at
    if at >= len(text):
        return "sign"
    c = text[at]
    if c.isdigit():
        return "digit"
    if c.isupper() or c.istitle():
        return "upper"
    if c.islower():
        return "camel" if _CAMEL.match(text, at) else "lower"
    return "other" if c.isalpha() else "sign"


def _greek(text: str, at: int) -> bool:
    """Is the nearest letter before ``at`` Greek?"""
    for c in reversed(text[max(0, at - 40) : at]):
        if c.isalpha():
            return "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿"
    return False


def _unvowelled(token: str) -> bool:
    """Is the token two to four Latin or Cyrillic letters, not all capitals, none of them a vowel? No word is."""
    if not 2 <= len(token) <= 4 or token.isupper():
        return False
    base = unicodedata.normalize("NFD", token.lower())
    return all("a" <= c <= "z" or "а" <= c <= "я" or unicodedata.combining(c) for c in base) and not set(base) & set("aeiouyаеёиоуыэюяіє")


def _point(text: str, start: int, marks: str, close: str, end: int, never: frozenset[str] = NEVER) -> int | None:
    """The symbol of one cluster of end marks, or None where no sentence can end.

    A sentence never ends before a lower-case word; an abbreviation or an initial
    does not end it at all, save those that often stand last (etc., p.m.).
    """
    n = len(text)
    if ";" in marks or ";" in marks:
        if marks.strip(";;") == "" and not (";" in marks or _greek(text, start)):
            return None
        marks = marks.replace(";", "?").replace(";", "?")
    nxt = text[end] if end < n else ""
    before = text[start - 1] if start else ""
    if _CJK_MARK.search(marks) or (set(marks) <= set("!?…") and (_IS_CJK.match(nxt or " ") or (_IS_CJK.match(before or " ")) or before in "％」”")):
        if _CJK_QUOTE.search(close):
            return CLOSE_AFTER_END
        if nxt in "，、,：:；" and nxt:
            return None
        return END
    if _PARA_AHEAD.match(text, end):
        return None
    if set(marks) & _PLAIN_ENDS and not close:
        return END
    spaced = nxt.isspace()
    if not spaced:
        if not _JOINED.match(text, end) or nxt in "=":
            return None
        run_ = _RUN.search(text[max(0, start - 24) : start])
        if set(marks) == {"."}:
            if len(marks) == 1 and run_ and (len(run_.group()) == 1 or run_.group().lower() in never):
                return None
            if nxt.isdigit() and not run_:
                return None
        return END
    f = end
    while text[f].isspace():
        f += 1
    kind = _kind(text, f)
    newline = "\n" in text[end:f] or "\r" in text[end:f]
    if kind == "dash":
        return END if newline and text[f] == "-" else None
    if kind == "lower":
        return None
    if marks == "." and not close:
        m = _TOKEN.search(text[max(0, start - 32) : start])
        tok = m.group() if m else ""
        if tok.isdigit():
            word = _LETTER.search(text[f : f + 1]) and re.match(r"\w+", text[f : f + 16])
            return None if word and word.group() in MONTHS else END_NUMBER
        low = tok.lower().rstrip(".")
        if low in ("a.m", "p.m", "etc", "usw", "deg"):
            return END
        earlier = text[max(0, start - len(tok) - 5) : start - len(tok)].rstrip()
        if low == "д" and earlier.endswith("т."):
            return END
        if low in never or (len(tok) == 1 and tok.isupper()):
            return None
        if _unvowelled(tok) and not earlier[-1:].isdigit():
            return None
        if len(tok) == 1 and tok.islower() and low == "h" and earlier.endswith("d."):
            return None
        return END
    if (set(marks) <= {".", "…"}) and (len(marks) > 1 or marks == "…") and kind == "other" and "ऀ" <= text[f] <= "ॿ":
        return None
    return END


def scan(text: str, never: frozenset[str] = NEVER, lo: int = 0, hi: int | None = None) -> tuple[list[int], list[int]]:
    """Symbols of a text, or of its part from ``lo`` to ``hi``, and the place where a sentence would end at each."""
    sym, pos = ([RESET], [0]) if lo == 0 else ([], [])
    last = lo
    for m in _POINTS.finditer(text, lo):
        kind, s, e = m.lastgroup, m.start(), m.end()
        if hi is not None and s >= hi:
            break
        if last < s and _LETTER.search(text, last, s):
            sym.append(WORD)
            pos.append(s)
        last = e
        if kind == "para":
            sym.append(PARAGRAPH)
            pos.append(s)
        elif kind == "close":
            close = m.group("close")
            me = m.end("mark")
            quotes = close.count('"')
            joined = quotes and e < len(text) and not text[e].isspace() and _JOINED.match(text, e)
            if not close and (o := _OPENED.match(text, me)) and o.group()[0] != '"' and _point(text, s, m.group("mark"), "", me, never) is None and set(m.group("mark")) & set("!?."):
                # an opening bracket follows at once
                got = END if not _RUN.search(text[max(0, s - 24) : s]) or len(_RUN.search(text[max(0, s - 24) : s]).group()) > 1 else None
            else:
                got = _point(text, s, m.group("mark"), close, e, never)
            if joined and got is not None:
                sym.append(END_IF_UNQUOTED)
                pos.append(me)
                got = END_IF_UNQUOTED
            for _ in range(quotes):
                sym.append(QUOTE)
                pos.append(e)
            if got is not None:
                sym.append(got)
                pos.append(e)
            elif _CJK_QUOTE.search(close):
                sym.append(CLOSE)
                pos.append(e)
        elif kind == "quote":
            sym.append(QUOTE)
            pos.append(e)
        elif kind == "copen":
            colon = text[:s].rstrip()[-1:] in (":", "：") if s < 64 else text[s - 64 : s].rstrip()[-1:] in (":", "：")
            sym.append(OPEN_AFTER_COLON if colon else OPEN)
            pos.append(s)
        elif kind == "cclose":
            sym.append(CLOSE)
            pos.append(e)
        else:
            sym.append(END)
            pos.append(s)
    return sym, pos


def _spans(text: str, ends: list[int]) -> Iterator[tuple[int, int, int]]:
    """(number of ends before it, start, end) of the visible part between successive ends."""
    a = 0
    for k, b in enumerate([*ends, len(text)]):
        seg = text[a:b]
        body = seg.strip()
        if body:
            lead = len(seg) - len(seg.lstrip())
            yield k, a + lead, a + lead + len(body)
        a = max(a, b)


def cut(texts: list[str], never: frozenset[str] = NEVER) -> list[list[tuple[int, int]]]:
    """(start, end) of the sentences of each text, in code points."""
    syms, poss, counts = [], [], []
    for t in texts:
        s, p = scan(t, never)
        syms.extend(s)
        poss.extend(p)
        counts.append(len(s))
    out = run(np.array(syms, np.uint8))
    pos = np.array(poss, np.int64)
    result, at = [], 0
    for t, k in zip(texts, counts):
        result.append([(a, b) for _, a, b in _spans(t, pos[at : at + k][out[at : at + k]].tolist())])
        at += k
    return result


# ---- abbreviations --------------------------------------------------------


def abbreviations(documents: DataFrame, most: int = MOST_LEARNED) -> frozenset[str]:
    """The seed and the abbreviations learned from all documents (lower case, without the last point).

    A short word is one when it hardly ever stands without a point and its points end
    a paragraph far less often than points of short words in general: by chance with
    odds below exp(-ODDS), by the Chernoff bound of the binomial tail. The counts are
    one aggregation over every row; only the ``most`` frequent ones come to the driver.
    """
    letter = r"[\\p{L}\\p{M}]"
    blank = r"[^\\S\\r\\n]*(?:\\r\\n|\\r|\\n)"
    pattern = rf"(?<!{letter})(?:\\p{{L}}\\.)*\\p{{L}}{letter}{{0,{LETTERS - 1}}}+(?!{letter})(?:\\.(?=\\s)(?:{blank}{blank})?+)?+"
    w = documents.where("text IS NOT NULL").select(F.explode(F.expr(f"regexp_extract_all(concat(text, '\\n\\n'), '{pattern}', 0)")).alias("w"))
    w = w.groupBy("w").agg(F.count("*").alias("n"))
    bare = F.regexp_replace("w", r"\s+$", "")
    w = w.select(F.lower(F.regexp_replace(bare, r"\.$", "")).alias("token"), bare.endswith(".").alias("point"), (F.length(bare) < F.length("w")).alias("last"), "n")
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("double")
    t = w.groupBy("token").agg(count(F.col("point")).alias("k"), count(~F.col("point")).alias("without"), count(F.col("last")).alias("ends"))
    usual = t.where("k > 0").agg(F.sum("ends") / F.sum("k")).scalar()
    c = t.where((F.col("k") > 0) & (F.col("without") <= WITHOUT_POINT * F.col("k"))).withColumn("p", usual).withColumn("q", F.col("ends") / F.col("k"))
    part = lambda a, b: F.when(a > 0, a * F.log(a / b)).otherwise(F.lit(0.0))
    odds = F.col("k") * (part(F.col("q"), F.col("p")) + part(1 - F.col("q"), 1 - F.col("p")))
    found = c.where((F.col("q") < F.col("p")) & (F.col("p") < 1) & (odds >= ODDS)).orderBy(F.desc("k"), "token").limit(most).select("token").collect()
    return NEVER | {r["token"] for r in found}


# ---- documents ------------------------------------------------------------


def _rows(never: frozenset[str]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            spans = cut([t or "" for t in texts], never)
            lens = [len(x) for x in spans]
            if sum(lens):
                at = pa.array(np.repeat(np.arange(len(texts)), lens))
                flat = np.array([z for x in spans for z in x], np.int64)
                yield pa.RecordBatch.from_arrays([ids.take(at), pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["doc_id", "sent_start", "sent_end"])

    return rows


_WITHIN = re.compile(r"[^\W_](?=[^\W_])")


def pieces(text: str, size: int) -> Iterator[tuple[int, int]]:
    """Ends of the pieces of a text: about ``size`` characters each, cut between two letters or digits."""
    lo = 0
    while lo < len(text):
        m = _WITHIN.search(text, lo + size) if lo + size < len(text) else None
        hi = m.end() if m else len(text)
        yield lo, hi
        lo = hi


def _long_sentences(documents: DataFrame, never: frozenset[str], size: int) -> DataFrame:
    """The sentences of long texts, whose pieces spread over tasks."""

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, doc, t in zip(*[c.to_pylist() for c in b.columns]):
                for no, (lo, hi) in enumerate(pieces(t, size)):
                    a = max(0, lo - AROUND)
                    yield pa.RecordBatch.from_pylist([{"row": row, "doc_id": doc, "no": no, "first": lo, "lead": lo - a, "text": t[a : hi + AROUND], "len": hi - lo}], schema=schema)

    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("no", pa.int32()), ("first", pa.int64()), ("lead", pa.int32()), ("text", pa.string()), ("len", pa.int32())])
    kinds = "row bigint, doc_id bigint, no int, first bigint, lead int, text string, len int"

    def symbols(r: dict) -> tuple[np.ndarray, list[int]]:
        # a piece in the middle of a text begins with context, or with nothing before it only at the text's start
        s, p = scan(r["text"], never, r["lead"], r["lead"] + r["len"])
        return np.array(s, np.uint8), p

    def function(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                s, _ = symbols(r)
                states, n = np.arange(16, dtype=np.uint8), np.zeros(16, np.int64)
                for x in s:
                    n += OUTPUT[x, states]
                    states = STEP[x, states]
                yield pa.RecordBatch.from_pylist([{"row": r["row"], "no": r["no"], "to": states.tolist(), "ends": n.tolist()}], schema=pa.schema([("row", pa.int64()), ("no", pa.int32()), ("to", pa.list_(pa.int32())), ("ends", pa.list_(pa.int64()))]))

    def sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                s, p = symbols(r)
                ends = np.array(p, np.int64)[run(s, entry=r["state"])] - r["lead"]
                own = r["text"][r["lead"] : r["lead"] + r["len"]]
                out = [{"row": r["row"], "doc_id": r["doc_id"], "sent": r["before"] + k, "a": r["first"] + x, "z": r["first"] + y} for k, x, y in _spans(own, ends.tolist())]
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=pa.schema([(c, pa.int64()) for c in ("row", "doc_id", "sent", "a", "z")]))

    p = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(apart, kinds)
    p = p.repartition("row", "no")
    # functions of 16 states, some hundred bytes a piece; a text is a row and has at most some thousand pieces
    f = p.select("row", "doc_id", "no", "first", "lead", "text", "len").mapInArrow(function, "row bigint, no int, to array<int>, ends array<bigint>")
    whole = f.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("no", "to", "ends"))).alias("f"))
    start = "array(named_struct('state', 0, 'before', 0L))"
    entered = F.expr(f"aggregate(f, {start}, (s, x) -> concat(s, array(named_struct('state', get(x.to, element_at(s, -1).state), 'before', element_at(s, -1).before + get(x.ends, element_at(s, -1).state)))))")
    e = whole.select("row", F.posexplode(entered).alias("no", "e")).select("row", "no", "e.state", "e.before")
    m = p.join(e, ["row", "no"]).mapInArrow(sentences, "row bigint, doc_id bigint, sent bigint, a bigint, z bigint")
    g = m.groupBy("row", "doc_id", "sent").agg(F.min("a").alias("sent_start"), F.max("z").alias("sent_end"))
    return g.select("doc_id", "sent_start", "sent_end")


def document_sentences(documents: DataFrame, size: int = LONG_TEXT) -> DataFrame:
    """doc_id, sent_start and sent_end of every sentence; places are code points, the end is exclusive.

    Null, empty and white texts have no rows. A text of up to ``size`` characters is
    cut where it stands, so nothing is shuffled; a longer one goes in pieces to many
    tasks, with the same result. A row that comes twice comes out twice; other columns
    are not read. A first pass learns the abbreviations.
    """
    never = abbreviations(documents)
    d = documents.where("text IS NOT NULL").select("doc_id", "text")
    long = F.length("text") > size
    short = d.where(~long).mapInArrow(_rows(never), "doc_id bigint, sent_start bigint, sent_end bigint")
    return short.unionByName(_long_sentences(d.where(long), never, size))


def sentence_units(documents: DataFrame) -> DataFrame:
    """The sentences themselves: doc_id, sent_no (from 0), sent_start, sent_end, sentence; each text is cut by one task."""
    never = abbreviations(documents)

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows = [(i, k, a, z, t[a:z]) for i, t, x in zip(ids, texts, cut([t or "" for t in texts], never)) for k, (a, z) in enumerate(x)]
            if rows:
                c = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in c[:4]], pa.array(c[4], pa.string())], ["doc_id", "sent_no", "sent_start", "sent_end", "sentence"])

    return documents.where(F.col("text").isNotNull()).select("doc_id", "text").mapInArrow(units, "doc_id bigint, sent_no bigint, sent_start bigint, sent_end bigint, sentence string")
