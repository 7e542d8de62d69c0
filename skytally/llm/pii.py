"""Personal data in texts, plain and disguised, as spans of the source's own characters.

Plain finders look for e-mail addresses, IPv4 addresses, card and phone numbers in the text as it is.  Then
three transducers rewrite it, one after the other: look-alike characters become ASCII and invisible ones
go; written-out signs ("(at)", "dot", "plus", entities) become the sign; spelled digits become digits, and
letters inside numbers the digit they look like.  Each keeps where it rewrote what, so that what the
same finders see in the rewritten text is mapped back to the characters it came from.  Such a span is added if
it reaches beyond the plain ones of its kind.  A text in which no transducer could act is not
rewritten; one pass of a regular expression without backtracking over a whole Arrow batch tells these apart.

An address whose sign was a bare "at" needs a disguised dot too, or a local part with more than letters and
a common top-level domain; one found by rewriting ends in letters.  So prose with "at" is left alone.

Every finder and transducer takes time in proportion to the text, however long, and rows are independent:
one pass, no shuffle.  A null text is empty and has no spans; repeated rows give repeated rows; a null id
stays null; other columns are not looked at; an empty table gives an empty result.  Positions are code points, ends exclusive,
spans sorted by kind, start and end.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# Letters of other scripts and the ASCII letters they look like.
LOOKALIKES = dict(zip(
    "авеһіјкмнорсԛтѕухԁԝ" "АВЕНІЈКМОРСТЅУХ" "αεικνορτυ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "ıӏ" "·。",
    "abehijkmhopcqtsyxdw" "ABEHIJKMOPCTSYX" "aeikvoptu" "ABEZHIKMNOPTYX" "il" "..",
    strict=True,
))
# Dashes and blanks that normalisation leaves alone, and characters without width.
LOOKALIKES |= dict.fromkeys("\u2010\u2011\u2012\u2013\u2014\u2015\u2212", "-")
LOOKALIKES |= dict.fromkeys("\u00ad\u200b\u200c\u200d\u2060\ufeff", "")
# The digits from 0 on in four languages, and other words for one of them.
DIGITS = [
    "zero one two three four five six seven eight nine".split(),
    "null eins zwei drei vier fünf sechs sieben acht neun".split(),
    "zéro un deux trois quatre cinq six sept huit neuf".split(),
    "cero uno dos tres cuatro cinco seis siete ocho nueve".split(),
    ["oh"],
]
AT, DOT = "at arroba arobase ät".split(), "dot punkt punto point".split()
REPEATS = {"double": 2, "triple": 3}
#: Top-level domains that make a bare "at" before a plain domain a sign.
DOMAINS = "com org net edu gov info biz io eu uk fr".split()


@cache
def lookalikes() -> dict[str, str]:
    """All characters that stand for one ASCII character: by the table, by compatibility, or as a digit."""
    found = {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        plain = unicodedata.normalize("NFKC", char)
        if len(plain) == 1 and " " <= plain <= "~":
            found[char] = plain
        elif unicodedata.category(char) == "Nd":
            found[char] = str(unicodedata.decimal(char))
    return found | LOOKALIKES


class Tape(NamedTuple):
    """A rewritten text; of each rewritten piece its begin and end here and in the source."""

    text: str
    begins: list[int]
    pieces: list[tuple[int, int, int, int]]

    def back(self, start: int, end: int) -> tuple[int, int]:
        """The source's span of a span of this text."""
        return self.place(start)[0], self.place(end - 1)[1]

    def place(self, at: int) -> tuple[int, int]:
        """The source's span of the character at a position."""
        k = bisect_right(self.begins, at) - 1
        if k < 0:
            return at, at + 1
        _, end, source, source_end = self.pieces[k]
        if at < end:
            return source, source_end
        return source_end + at - end, source_end + at - end + 1


def rewrite(text: str, pattern: re.Pattern, output: Callable[[re.Match], str | None]) -> Tape:
    """Replace what the pattern finds by ``output``; None leaves it."""
    parts, begins, pieces, done, size = [], [], [], 0, 0
    for m in pattern.finditer(text):
        new = output(m)
        if new is None:
            continue
        size += m.start() - done
        parts += (text[done : m.start()], new)
        begins.append(size)
        pieces.append((size, size + len(new), m.start(), m.end()))
        size, done = size + len(new), m.end()
    return Tape("".join([*parts, text[done:]]) if pieces else text, begins, pieces)


def _either(words) -> str:
    return "|".join(sorted({re.escape(w) for w in words}, key=lambda w: (-len(w), w)))


def _ranges(chars) -> str:
    """The inside of a character class."""
    codes, parts = sorted(map(ord, chars)), []
    for c in codes:
        if parts and parts[-1][1] == c - 1:
            parts[-1][1] = c
        else:
            parts.append([c, c])
    return "".join(re.escape(chr(a)) + (f"-{re.escape(chr(b))}" if b > a else "") for a, b in parts)


_DIGIT = {word: str(k) for words in DIGITS for k, word in enumerate(words)}
_BLANK, _SOME = r"[ \t]{0,3}", r"[ \t]{1,3}"
_LETTER = "A-Za-zÀ-ɏ"
_ANY_DIGIT = _either(_DIGIT)


def _wrapped(words, sign: str) -> str:
    word = f"(?:{_either(words)}|{sign})"
    return rf"{_BLANK}(?:\[{_BLANK}{word}{_BLANK}\]|\({_BLANK}{word}{_BLANK}\)|\{{{_BLANK}{word}{_BLANK}\}}|<{_BLANK}{word}{_BLANK}>){_BLANK}"


def _between(words) -> str:
    return "|".join(rf"\{c}(?:{_either(words)})\{c}" for c in "-_*~")


_ANY_DOT = rf"(?:{_wrapped(DOT, r'\.')}|{_between(DOT)}|{_SOME}(?:{_either(DOT)}){_SOME}|&\#0*46;|&\#x0*2e;|&period;|%2e)"
_HOST = r"[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}"


@cache
def _looks() -> re.Pattern:
    return re.compile(f"[{_ranges(lookalikes())}]")


_SIGNS = re.compile(
    rf"""(?P<at>{_wrapped(AT, '@')}|{_between(AT)}|{_SOME}@{_BLANK}|@{_SOME}|&\#0*64;|&\#x0*40;|&commat;|%40
        |{_SOME}(?:{_either(AT)}){_SOME}(?={_HOST}{_ANY_DOT}[A-Za-z0-9]))
    |(?P<bare>{_SOME}(?:{_either(AT)}){_SOME}(?=[A-Za-z0-9]))
    |(?P<dot>{_ANY_DOT})
    |(?P<plus>(?<![{_LETTER}0-9])plus{_SOME}(?=[0-9(]|(?:{_ANY_DIGIT})(?![{_LETTER}])))""".replace("[ \\t]", "[\\ \\t]"),
    re.I | re.X,
)
_NUMBERS = re.compile(
    rf"""(?P<spelled>(?<![{_LETTER}0-9])(?:(?:{_either(REPEATS)})[\ -])?(?:{_ANY_DIGIT})
        (?:[\ \t,-]{{1,2}}(?:(?:{_either(REPEATS)})[\ -])?(?:{_ANY_DIGIT})(?![{_LETTER}0-9]))*(?![{_LETTER}0-9]))
    |(?P<mixed>(?<![{_LETTER}0-9])[0-9OoIl]{{2,20}}(?![{_LETTER}0-9])|(?<=\+)[OoIl](?![{_LETTER}]))""",
    re.I | re.X,
)
_PLAIN_HOST = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:\.[A-Za-z0-9-]{{1,63}}){{0,8}}\.(?:{_either(DOMAINS)})(?![A-Za-z0-9-])", re.I)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _sign(m: re.Match) -> str | None:
    kind = m.lastgroup
    if kind == "bare":
        start = m.start()
        while start > 0 and m.start() - start < 64 and m.string[start - 1] in _LOCAL:
            start -= 1
        local = m.string[start : m.start()]
        return "@" if local.strip("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") and _PLAIN_HOST.match(m.string, m.end()) else None
    return {"at": "@", "dot": ".", "plus": "+"}[kind]


def _number(m: re.Match) -> str | None:
    found = m.group()
    if m.lastgroup == "mixed":
        if found.isdigit() or len(found) > 1 and not any(c.isdigit() for c in found):
            return None
        return found.translate({79: "0", 111: "0", 73: "1", 105: "1", 76: "1", 108: "1"})
    words = re.split(r"[ \t,-]+", found.lower())
    if len(words) == 1:
        # One word alone is a digit only where a sign holds it to something.
        before, after = m.string[m.start() - 1 : m.start()], m.string[m.end() : m.end() + 1]
        if not (before and before in "+.-(" or after and after in ".-)"):
            return None
    times, out = 1, []
    for word in words:
        if word in REPEATS:
            times = REPEATS[word]
        else:
            out.append(_DIGIT[word] * times)
            times = 1
    return "".join(out)


@cache
def _trigger() -> str:
    """What any rewriting needs, for an engine without look-around; it may find more."""
    wrap = f"(?:{_either([*AT, *DOT])}|@|\\.)"
    parts = [
        rf"[\[({{<*~_-][ \t]*{wrap}[ \t]*[\])}}>*~_-]",
        rf"[ \t](?:{_either(DOT)})[ \t]",
        r"&#|&commat;|&period;|%40|%2e|[ \t]@|@[ \t]",
        rf"[0-9._%+-][A-Za-z]*[ \t]+(?:{_either(AT)})[ \t]+[A-Za-z0-9.-]+\.[A-Za-z]",
        rf"\b(?:{_either([*_DIGIT, *REPEATS])})[ \t,-]{{1,2}}(?:{_either([*_DIGIT, *REPEATS])})",
        rf"[+.(-](?:{_ANY_DIGIT})\b|\b(?:{_ANY_DIGIT})[.)-]",
        r"\bplus[ \t]",
        r"[0-9+][OoIl]|[OoIl][0-9]",
    ]
    # Without regard to case a class with the Kelvin sign would find every k.
    return f"[{_ranges(lookalikes())}]|(?i:{'|'.join(parts)})"


# --- finders --------------------------------------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++){3,}+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    found, end, sign = [], 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        host = _DOMAIN.match(text, sign + 1) if start < sign else None
        if host:
            end = host.end()
            found.append((start, end))
        sign = text.find("@", max(sign + 1, end))
    return found


def addresses(text: str) -> list[tuple[int, int]]:
    """Each four parts of a chain of numbers in turn."""
    found = []
    for m in _CHAIN.finditer(text):
        start, parts = m.start(), m.group().split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p) <= 3 and int(p) <= 255 for p in (p.lstrip("0") or "0" for p in four)):
                found.append((start, end))
            start = end + 1
    return found


_TWICE = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


def luhn(digits: str) -> bool:
    total = sum(_TWICE[int(d)] if k % 2 else int(d) for k, d in enumerate(reversed(digits)))
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= sum(map(m.group().count, "0123456789")) <= 15]


FINDERS = dict(zip(KINDS, (emails, addresses, cards, phones)))


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    return [(kind, *span) for kind in KINDS for span in FINDERS[kind](text)]


def disguised_spans(text: str, plain: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """What the finders see in the rewritten text only, as spans of the text itself."""
    tapes, now = [], text
    steps = [(_SIGNS, _sign), (_NUMBERS, _number)]
    if not text.isascii():
        table = lookalikes()
        steps.insert(0, (_looks(), lambda m: table[m.group()]))
    for pattern, output in steps:
        tapes.append(rewrite(now, pattern, output))
        now = tapes[-1].text
    if now is text:
        return []
    found = []
    for kind in KINDS:
        known = [(a, b) for k, a, b in plain if k == kind]
        starts = [a for a, _ in known]
        for start, end in FINDERS[kind](now):
            if kind == "email" and not re.search(r"\.[A-Za-z]{2,}\Z", now[max(start, end - 70) : end]):
                continue
            for tape in reversed(tapes):
                start, end = tape.back(start, end)
            k = bisect_right(starts, start) - 1
            if k < 0 or known[k][1] < end:
                found.append((kind, start, end))
    return found


def _sorted(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def scan(texts: pa.Array) -> Iterator[tuple[list, list]]:
    """(plain spans, all spans) of each text."""
    texts = texts.fill_null("")
    rewritten = pc.match_substring_regex(texts, _trigger()).to_pylist()
    for k, text in enumerate(texts):
        text = text.as_py()
        plain = plain_spans(text)
        more = disguised_spans(text, plain) if rewritten[k] else []
        yield plain, (_sorted(plain + more) if more else plain)


_SPANS = "array<struct<kind: string, start: long, end: long>>"


def _lists(rows: list[list[tuple[str, int, int]]]) -> pa.ListArray:
    ends, flat = [0], []
    for row in rows:
        flat += row
        ends.append(len(flat))
    kind, start, end = zip(*flat) if flat else ((), (), ())
    parts = [pa.array(kind, pa.string()), pa.array(start, pa.int64()), pa.array(end, pa.int64())]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(parts, ["kind", "start", "end"]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = list(scan(batch.column(1)))
        columns = [batch.column(0), _lists([p for p, _ in found]), _lists([a for _, a in found])]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "plain", "spans"])


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, plain, spans) of each row: the plain spans, and all, as (kind, start, end)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_find, f"doc_id long, plain {_SPANS}, spans {_SPANS}")


def joined(spans: Column) -> Column:
    """kind:start:end of each span, with commas between."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, text: str = "text", mark: str = "[{}]") -> DataFrame:
    """``docs`` with every span replaced by a mark that names its kind; overlapping spans become one."""

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        out = []
        for value, (_, spans) in zip(texts, scan(pa.array(texts, pa.large_string(), from_pandas=True))):
            parts, done = [], 0
            for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
                if start >= done:
                    parts += (value[done:start], mark.format(kind))
                done = max(done, end)
            out.append("".join([*parts, value[done:]]) if parts else value)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text, masked(F.col(text)))
