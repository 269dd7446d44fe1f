"""Personal data with offset-preserving deobfuscation.

A text is read twice. The base patterns run on the text as it is. Then
transducers rewrite disguises (homoglyphs and full-width forms, spelled
digits, ``at``/``dot`` in words or brackets, ``at`` by itself before a domain) into a normalised text that
remembers, for each of its characters, the source characters it came
from. The same detectors run on the normalised text, and a match that a
rewritten character takes part in is mapped back to source offsets.

Defined results: null text counts as empty, an empty text has no span,
texts of any length are read whole, repeated rows give repeated results,
and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame

from .common import documents

KINDS = ("email", "ip", "card", "phone")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_RUN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping; walks from @ to @, so the cost stays linear."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_SET:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """A failed attempt inside a run of digits can't succeed further on in the
    run, so a start after a digit is skipped unless a match ended there."""
    out = []
    if "." not in text:
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(m.span())
    return out


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for d in digits[-2::-2]:
        total += int(d) * 2 - 9 * (d > "4")
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _RUN.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


def detect(text: str) -> dict[str, list[tuple[int, int]]]:
    return {"email": emails(text), "ip": ips(text), "card": cards(text), "phone": phones(text)}


# Letters of other scripts that look like ASCII letters.
_LOOKALIKE = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "ԁ": "d", "һ": "h", "ո": "n", "ӏ": "l", "ѵ": "v", "ԝ": "w", "ԛ": "q", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "Х": "X", "У": "Y", "І": "I", "Ј": "J", "Ѕ": "S", "З": "3",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "χ": "x", "ϲ": "c", "γ": "y",
    "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Χ": "X", "Υ": "Y", "Ζ": "Z", "ı": "i", "ɡ": "g", "ɑ": "a",
    "\u2024": ".", "\u3002": ".", "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-",
    "\u00a0": " ", "\u2007": " ", "\u2009": " ", "\u202f": " ",
}
#: one character to one character: full-width forms by rule, digits of other scripts by value
_GLYPHS = {ord(k): v for k, v in _LOOKALIKE.items()}
_GLYPHS |= {0xFF01 + i: chr(0x21 + i) for i in range(94)}
_GLYPHS |= {z + d: str(d) for z in (0x660, 0x6F0, 0x966, 0x9E6, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6) for d in range(10)}
_GLYPH = re.compile("[" + "".join(map(re.escape, map(chr, _GLYPHS))) + "]")
#: characters without width, dropped
_HIDDEN = re.compile("[\u200b\u200c\u200d\u2060\ufeff\u00ad]")
# Names of digits.
_SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
            "seven": "7", "eight": "8", "nine": "9"}
_WORD = "(?:" + "|".join(_SPELLED) + ")"
#: four spelled or plain numbers in a row at least, so that prose with a number word stays as it is
_DIGITS = re.compile(rf"(?<![A-Za-z0-9])(?:plus[\x20])?(?:{_WORD}|[0-9]+)(?:[\x20,.-]{{1,2}}(?:{_WORD}|[0-9]+|dot|point)(?![A-Za-z])){{3,}}", re.I)
_TOKEN = re.compile(rf"plus|{_WORD}|dot|point|[0-9]+", re.I)
_HAS_SPELLED = re.compile(rf"(?<![A-Za-z]){_WORD}[\x20,.-]{{1,2}}(?:{_WORD}|[0-9]|dot|point)(?![A-Za-z])", re.I)
# Words for at and dot, top levels that a bare "at" needs behind it.
_DOT = r"(?:[\x20]*[\[({<][\x20]*(?:dot|punkt|point|punto|\.)[\x20]*[\])}>][\x20]*|[\x20]+(?:dot|punkt)[\x20]+|\.)"
_TOD = r"(?:[\x20]*[\])}>][\x20]*(?:tod|tknup|tniop|otnup|\.)[\x20]*[\[({<][\x20]*|[\x20]+(?:tod|tknup)[\x20]+|\.)"
_LABEL = r"[A-Za-z0-9-]++"
_AT = re.compile(r"[\[({<][\x20]*(?:at|@|ät)[\x20]*[\])}>]|(?<=[\x20])at(?=[\x20])|@", re.I)
#: the domain of a disguised address, read forward from its at
_TAIL = re.compile(rf"{_LABEL}(?:{_DOT}{_LABEL})++", re.I)
#: its local part, read backward; any number of parts
_LOCAL_BACK = re.compile(rf"[A-Za-z0-9_%+-]++(?:{_TOD}[A-Za-z0-9_%+-]++)*+", re.I)
_DOT_ONLY = re.compile(_DOT, re.I)
_TOP = frozenset("""com org net edu gov mil int info biz name pro mobi coop museum aero jobs travel app dev online site tech store shop blog cloud xyz
ac ad ae af ag ai al am ao ar as at au aw az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bw by bz ca cc cd cf cg ch ci ck cl cm cn co cr cu
cv cy cz de dj dk dm do dz ec ee eg er es et eu fi fj fk fm fo fr ga gb gd ge gf gg gh gi gl gm gn gp gq gr gt gu gw gy hk hn hr ht hu id ie
il im in io iq ir is it je jm jo jp ke kg kh ki km kn kr kw ky kz la lb lc li lk lr ls lt lu lv ly ma mc md me mg mh mk ml mm mn mo mq mr ms
mt mu mv mw mx my mz na nc ne nf ng ni nl no np nr nu nz om pa pe pf pg ph pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd se sg sh
si sk sl sm sn so sr ss st su sv sy sz tc td tf tg th tj tk tl tm tn to tr tt tv tw tz ua ug uk us uy uz va vc ve vg vi vn vu wf ws ye za zm zw""".split())
#: what announces an address before a local part that is a plain word, and words that are none all the same
_CUE = re.compile(r"(?<![A-Za-z])(?:e-?mail(?:s|ed|ing)?|mail(?:s|ed|ing)?|contact(?:s|ed|ing)?|writ(?:e|es|ing)|reach(?:es|ed|ing)?|address(?:es|ed)?)"
                  r"(?:[\x20](?:me|us|him|her|them))?(?:[\x20](?:to|is|at|under|via))?(?:[\x20]?:)?[\x20]\Z", re.I)
_NO_LOCAL = frozenset("""me us him her them you it this that these those one someone everyone anyone people
information details address addresses form page server list account office only and or
out back now here there directly""".split())
_HINT = re.compile(r"[\[({<][\x20]*(?:at|@|ät|dot|punkt|point|punto|\.)[\x20]*[\])}>]|[\x20](?:dot|punkt|at)[\x20]|[\x20]@|@[\x20]", re.I)


class Normalised:
    """A text with, for each character, its source span and whether it was rewritten."""

    def __init__(self, text: str):
        self.text, self.start, self.end, self.new = text, None, None, None

    def _open(self) -> None:
        if self.start is None:
            n = len(self.text)
            self.start, self.end, self.new = list(range(n)), list(range(1, n + 1)), bytearray(n)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace [from, to) by a string, for ascending, disjoint edits; a
        replacement's characters all stand for the whole replaced span."""
        if not edits:
            return
        self._open()
        parts, start, end, new, done = [], [], [], bytearray(), 0
        for a, b, put in [*edits, (len(self.text), len(self.text), "")]:
            parts += [self.text[done:a], put]
            start += self.start[done:a]
            end += self.end[done:a]
            new += self.new[done:a]
            if put:
                start += [self.start[a]] * len(put)
                end += [self.end[b - 1]] * len(put)
                new += b"\1" * len(put)
            done = b
        self.text, self.start, self.end, self.new = "".join(parts), start, end, new

    def source(self, a: int, b: int) -> tuple[int, int] | None:
        """Source span of [a, b), or None where nothing in it was rewritten."""
        if self.start is None or not any(self.new[a:b]):
            return None
        return self.start[a], self.end[b - 1]


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Runs of spelled digits become digits; the separators of a run go, but
    dots (as character or word) stay dots, which keeps addresses of hosts."""
    out = []
    for m in _DIGITS.finditer(text):
        tokens = [(m.start() + t.start(), m.start() + t.end(), t[0].lower()) for t in _TOKEN.finditer(m[0])]
        if sum(w in _SPELLED for _, _, w in tokens) < 2:
            continue
        dotted = any(w in ("dot", "point") for _, _, w in tokens) or "." in m[0]
        done = m.start()
        for a, b, w in tokens:
            if a > done and text[done:a] != ".":
                out.append((done, a, "." if dotted and "." in text[done:a] else ""))
            if not w[0].isdigit():
                out.append((a, b, {"plus": "+", "dot": ".", "point": "."}.get(w) or _SPELLED[w]))
            done = b
    return out


def _plausible(text: str, start: int, end: int, tail: str) -> bool:
    """Whether [start, end) and ``tail`` around a bare "at" read as an address: a known top level,
    and a local part that looks like one or is announced."""
    local, top = text[start:end], tail.rsplit(".", 1)[1]
    if top.lower() not in _TOP or not (top.islower() or top.isupper()) or not any(c.isalpha() for c in local):
        return False
    if any(c in "._" or c.isdigit() for c in local) or _DOT_ONLY.search(local):
        return True
    return local.lower() not in _NO_LOCAL and _CUE.search(text[max(0, start - 40):start]) is not None


def _addresses(text: str) -> list[tuple[int, int, str]]:
    """From each at, the domain is read forward and the local part backward. What lies before an at
    with a domain isn't read again, so the cost stays linear."""
    out, done = [], 0
    for m in _AT.finditer(text):
        a, b = m.span()
        if a < done:
            continue
        while a > done and text[a - 1] == " ":
            a -= 1
        while b < len(text) and text[b] == " ":
            b += 1
        domain = _TAIL.match(text, b)
        if not domain:
            continue
        local = _LOCAL_BACK.match(text[done:a][::-1])
        start, done = a - local.end() if local else a, a
        if start and text[start - 1] in _LOCAL_SET:  # a stray dot before it: from the first disguised dot on
            start += next((d.end() for d in _DOT_ONLY.finditer(text[start:a]) if d[0] != "."), a - start)
        if start == a:
            continue
        tail = domain[0]
        disguised = [d for d in _DOT_ONLY.finditer(tail) if d[0] != "."]
        if m[0].lower() == "at" and not disguised and not _plausible(text, start, a, tail):
            continue
        done = domain.end()
        if text[a:b] != "@":
            out.append((a, b, "@"))
        for base, part in ((start, text[start:a]), (b, tail)):
            out += [(base + d.start(), base + d.end(), ".") for d in _DOT_ONLY.finditer(part) if d[0] != "."]
    return sorted(out)


def normalise(text: str) -> Normalised:
    """The transducers, one after the other; each reads what the one before wrote."""
    n = Normalised(text)
    if not text.isascii():
        n.rewrite([(m.start(), m.end(), "") for m in _HIDDEN.finditer(n.text)])
        n.rewrite([(m.start(), m.end(), _GLYPHS[ord(m[0])]) for m in _GLYPH.finditer(n.text)])
    if _HAS_SPELLED.search(n.text):
        n.rewrite(_spelled(n.text))
    if _HINT.search(n.text):
        n.rewrite(_addresses(n.text))
    return n


def spans(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans) as (kind, start, end) in code points."""
    text = text or ""
    base = detect(text)
    every = {k: set(v) for k, v in base.items()}
    n = normalise(text)
    if n.start is not None:
        for kind, found in detect(n.text).items():
            for a, b in found:
                if (s := n.source(a, b)) and not any(x <= s[0] and s[1] <= y for x, y in base[kind]):
                    every[kind].add(s)
    flat = lambda d: [(k, a, b) for k in KINDS for a, b in sorted(d[k])]
    return flat(base), flat(every)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, base and found (arrays of kind, start, end)."""
    schema = ("doc_id long, base array<struct<kind string, start int, end int>>, "
              "found array<struct<kind string, start int, end int>>")

    def run(batches):
        for pdf in batches:
            both = [spans(t) for t in pdf["text"]]
            as_rows = lambda s: [{"kind": k, "start": a, "end": b} for k, a, b in s]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "base": [as_rows(b) for b, _ in both],
                                "found": [as_rows(a) for _, a in both]})

    return documents(docs, id_col, text_col).mapInPandas(run, schema)


def joined_spans(found) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
