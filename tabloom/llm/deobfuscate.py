"""Personal data in plain and disguised form, reported at its place in the source text.

Detectors run twice: over the text as it stands, and over a normalised text in which transducers have rewritten
homoglyphs, bracketed and bare at/dot disguises and spelled digits, one after another, so that mixed forms compose. Every
character keeps its source interval, so a span that is found in the normalised text maps back to source characters;
spans that touch no rewrite are those of the first pass and are not reported twice. Every detector takes time in
proportion to the text. A bare at before a plain domain is rewritten only if the domain has another disguise or the name
before it has a mark inside: "john at example.com" is otherwise like "available at example.com".

Defined cases: a null text is empty; null doc_ids pass through; repeated rows each return a row; an empty table gives
an empty result; other columns are ignored; no span gives the empty string and its digest.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabloom.llm.common import batch_of, slices, texts_of

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# fixed values: letters that look like an ASCII letter and have no compatibility form
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "һ": "h", "ո": "n", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "Α": "A",
    "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "ɑ": "a",
}
# fixed values: characters without width
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
# fixed values: digits by name in the four languages of the texts
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9", "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5",
    "sechs": "6", "sieben": "7", "acht": "8", "neun": "9", "zéro": "0", "un": "1", "deux": "2", "trois": "3",
    "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9", "cero": "0", "uno": "1", "dos": "2",
    "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
SIGN_WORDS = {"plus": "+", "dot": ".", "point": ".", "dash": "-"}
FEWEST_DIGITS = 4
DIGIT_NAMES = frozenset(DIGIT_WORDS)

_DIGIT = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
SPELLED = re.compile(rf"(?i:(?<!\w)(?:plus[ -])?(?:{_DIGIT})(?:[ ,-]{{1,2}}(?:(?:{"|".join(SIGN_WORDS)})[ ,-]{{1,2}})?(?:{_DIGIT}))*+(?!\w))")
_GAP = r"(?:[ ,.()-]{0,2}|[ ](?:dot|point|dash)[ ])"
BEFORE_DIGITS, AFTER_DIGITS = re.compile(rf"(?i:{_GAP}[0-9])"), re.compile(rf"(?i:[0-9+]{_GAP}\Z)")
SIGN_BETWEEN = re.compile(r"(?i:(?<=[0-9])[ ](?:(?P<dot>dot|point)|dash)[ ](?=[0-9]))")
SPELLED_WORD = re.compile(r"\w+")
BRACKETED = re.compile(r"(?i:[\[({<][ ]?(?:(?P<at>at|@|arroba)|dot|\.|punkt|punto|point)[ ]?[\])}>])")
BARE = re.compile(
    r"(?i:(?:[ ]at[ ]|@)[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?:[ ]dot[ ][A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+)++)"
)
BARE_AT = re.compile(r"(?i:[ ]at[ ][A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)")
MARKED_NAME = re.compile(r"(?=[^A-Za-z]*+[A-Za-z])[A-Za-z0-9]++(?:[._%+][A-Za-z0-9]++)++|[A-Za-z]++[0-9]++")
BARE_UNIT = re.compile(r"(?i:[ ](?P<at>at)[ ]|[ ]dot[ ])")


@lru_cache(1)
def stand_ins() -> dict[str, str]:
    """Characters with an ASCII stand-in, by compatibility form or by look."""
    table = dict(LOOKALIKES) | dict.fromkeys(INVISIBLE, "")
    for code in range(0x80, 0x1FC00):
        form = unicodedata.normalize("NFKC", chr(code))
        if len(form) == 1 and form.isascii() and form.isprintable() and form != " ":
            table[chr(code)] = form
        elif unicodedata.category(chr(code)) == "Nd":
            table[chr(code)] = str(unicodedata.digit(chr(code)))
    return table


def email_spans(text: str) -> list[tuple[int, int]]:
    spans, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            spans.append((start, last))
        at = text.find("@", max(at + 1, last))
    return spans


def ip_spans(text: str) -> list[tuple[int, int]]:
    def small(part: str) -> bool:
        return len(part := part.lstrip("0") or "0") <= 3 and int(part) <= 255

    return [m.span() for m in IP.finditer(text) if all(map(small, m.group().split(".")))]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def card_spans(text: str) -> list[tuple[int, int]]:
    spans = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(m.span())
    return spans


def phone_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m.group())) <= 15]


DETECTORS = {"email": email_spans, "ip": ip_spans, "card": card_spans, "phone": phone_spans}


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    return {kind: DETECTORS[kind](text) for kind in KINDS}


def name_start(text: str, end: int, least: int) -> int:
    """Where a name that ends at ``end`` begins: words joined by a dot or the word dot."""
    start = at = end
    while True:
        while at > least and text[at - 1] in LOCAL:
            at -= 1
        if at == start:  # no word here
            return start if start == end or text[start : start + 5] != " dot " else start + 5
        start = at
        if at - 5 >= least and text[at - 5 : at] == " dot ":
            start = at = at - 5
        else:
            return start


class Rewritten:
    """A text in the course of its rewrites; every character has its source interval and whether it was rewritten."""

    def __init__(self, text: str):
        self.text = text
        self.starts = np.arange(len(text))
        self.ends = self.starts + 1
        self.new = np.zeros(len(text), bool)

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Edits (start, end, replacement) in order and without overlap; a replacement has the interval of what it replaces."""
        if not edits:
            return
        texts, starts, ends, new, at = [], [], [], [], 0
        for start, end, piece in [*edits, (len(self.text), len(self.text), "")]:
            texts += [self.text[at:start], piece]
            starts.append(self.starts[at:start])
            ends.append(self.ends[at:start])
            new.append(self.new[at:start])
            if piece:
                starts.append(np.full(len(piece), self.starts[start]))
                ends.append(np.full(len(piece), self.ends[end - 1]))
                new.append(np.ones(len(piece), bool))
            at = end
        self.text = "".join(texts)
        self.starts, self.ends, self.new = map(np.concatenate, (starts, ends, new))


def homoglyphs(now: Rewritten) -> list[tuple[int, int, str]]:
    if now.text.isascii():
        return []
    table = stand_ins()
    present = table.keys() & set(now.text)
    if not present:
        return []
    pattern = "[" + "".join(map(re.escape, sorted(present))) + "]"
    return [(m.start(), m.end(), table[m.group()]) for m in re.finditer(pattern, now.text)]


def bracketed(now: Rewritten) -> list[tuple[int, int, str]]:
    text, found, last = now.text, [], 0
    for m in BRACKETED.finditer(text):
        start, end = m.span()
        start -= start > last and text[start - 1] == " "
        last = end + (text[end : end + 1] == " ")
        found.append((start, last, "@" if m["at"] else "."))
    return found


def bare_dots(now: Rewritten) -> list[tuple[int, int, str]]:
    text, found, last = now.text, [], 0
    lowered = text.lower()
    if " dot " not in lowered:
        return []
    for m in BARE.finditer(text):
        start = name_start(lowered if len(lowered) == len(text) else text, m.start(), last)
        if start < m.start():
            for u in BARE_UNIT.finditer(text, start, m.end()):
                found.append((u.start(), u.end(), "@" if u["at"] else "."))
        last = m.end()
    return found


def bare_ats(now: Rewritten) -> list[tuple[int, int, str]]:
    """Where the dot is a plain one: at a domain with another disguise, or after a name with a mark inside."""
    text, found, last = now.text, [], 0
    for m in BARE_AT.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start() and (now.new[start : m.end()].any() or MARKED_NAME.fullmatch(text, start, m.start())):
            found.append((m.start(), m.start() + 4, "@"))
        last = m.start() + 4
    return found


def spelled_digits(now: Rewritten) -> list[tuple[int, int, str]]:
    """Runs of digit names: long ones, and those of any length beside digits or other runs."""
    text = now.text
    words = SPELLED_WORD.findall(text.lower())
    if DIGIT_NAMES.isdisjoint(words):
        return []
    if sum(map(DIGIT_NAMES.__contains__, words)) < FEWEST_DIGITS and not any(map(str.isdigit, words)):
        return []
    runs = []
    for m in SPELLED.finditer(text):
        units = [u.lower() for u in SPELLED_WORD.findall(m.group())]
        piece = "".join(DIGIT_WORDS.get(u) or SIGN_WORDS[u] for u in units)
        runs.append((m.start(), m.end(), piece, sum(u in DIGIT_WORDS for u in units)))
    gap = lambda a, b: b - a <= 3 and not text[a:b].strip(" ,.()-")
    # a chain of runs and digits is taken as a whole
    found, chain, touches, digits, last = [], [], False, 0, -9
    for start, end, piece, n in [*runs, (len(text) + 9, len(text) + 9, "", 0)]:
        if chain and not gap(last, start):
            if touches or digits >= FEWEST_DIGITS:
                found += chain
            chain, touches, digits = [], False, 0
        if piece:
            chain.append((start, end, piece))
            digits += n
            touches |= bool(AFTER_DIGITS.search(text[max(0, start - 8) : start]) or BEFORE_DIGITS.match(text, end))
            last = end
    return found


def signs_between(now: Rewritten) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), "." if m["dot"] else "-") for m in SIGN_BETWEEN.finditer(now.text)]


def normalised(text: str) -> Rewritten:
    now = Rewritten(text)
    for transducer in (homoglyphs, bracketed, bare_dots, bare_ats, spelled_digits, signs_between):
        now.apply(transducer(now))
    return now


def rewrites(text: str) -> list[tuple[int, int, str]]:
    """(start, end, replacement) of every disguise, in order and without overlap."""
    now = normalised(text)
    found: list[tuple[int, int, str]] = []
    last = 0
    for letter, start, end, new in zip(now.text, now.starts.tolist(), now.ends.tolist(), now.new.tolist(), strict=True):
        if start > last:
            found.append((last, start, ""))
        if new:
            if found and found[-1][:2] == (start, end):
                found[-1] = (start, end, found[-1][2] + letter)
            else:
                found.append((start, end, letter))
        last = end
    return [*found, (last, len(text), "")] if last < len(text) else found


def disguised_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans that are found only after normalising, in source positions."""
    now = normalised(text)
    if now.text == text:
        return {}
    added = {}
    for kind in KINDS:
        spans = []
        for start, end in DETECTORS[kind](now.text):
            first, last = int(now.starts[start]), int(now.ends[end - 1])
            if now.new[start:end].any() or last - first != end - start:
                spans.append((first, last))
        if spans:
            added[kind] = spans
    return added


def all_spans(text: str) -> tuple[dict, dict]:
    base = base_spans(text)
    more = disguised_spans(text)
    return base, {k: sorted({*base[k], *more.get(k, ())}) for k in KINDS}


def joined(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in spans[k])


RESULT = pa.schema(
    [("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()),
     ("spans", pa.string()), ("n_disguised", pa.int64())]
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        rows = []
        for text in batch.column(1).to_pylist():
            base, every = all_spans(text)
            counts = [len(base[k]) for k in KINDS]
            digest = sha256(joined(base).encode()).hexdigest()
            rows.append((*counts, digest, joined(every), sum(map(len, every.values())) - sum(counts)))
        yield batch_of(RESULT, batch.column(0), *(zip(*rows, strict=True) if rows else [[]] * 7))


def find_personal_data(documents: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """One row per document: counts of plain spans by kind, their digest, all spans, the number of disguised ones."""
    schema = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in RESULT)
    return texts_of(documents, id_column, text_column).mapInArrow(_scan, schema)


def masked(text: str | None) -> str | None:
    """The text with every span, plain or disguised, replaced by its kind in brackets."""
    if not text:
        return text
    _, every = all_spans(text)
    spans = sorted((s, e, k) for k in KINDS for s, e in every[k])
    if not spans:
        return text
    pieces, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            pieces += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def mask_documents(documents: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents with personal data in the text column replaced; other columns, nulls and empty texts stay."""
    place = documents.columns.index(text_column)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place):
            texts = pa.array([masked(t) for t in batch.column(place).to_pylist()], batch.schema.field(place).type)
            columns = [texts if i == place else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return documents.mapInArrow(mask, documents.schema)
