"""PII surrogates: entities get keyed replacements of the same type, script, gender and format.

Detected are e-mail addresses, phone numbers, IPv4 addresses, card-like numbers of 13 to 19 digits, US social security
numbers, IBANs, and names of any script after a form of address (Mr, Frau, Señora, ...) or of introduction (my name is),
which are then found without it in the same text too. Names that no text introduces so are not found. An entity is its
type and normal form (case, punctuation and spacing aside), so each mention of it in any document gets the same
surrogate, in the mention's own format. A name whose gender one text does not tell has the one that the corpus' other
texts tell, unless they differ; whether a last name alone means a longer name is decided within a text.

Surrogates of numbers, IBANs and e-mail parts are a keyed permutation (a Feistel network with cycle walking) of the
entities of the same pattern of letter and digit places: distinct entities cannot meet. Country codes and leading zeros of
phone numbers, countries of IBANs and top-level domains stay; check digits of cards and IBANs are right where they were.
Names are spelt from syllables of their script, or letters of their Unicode block, and keep the gender of their form of
address. A corpus-wide check confirms distinctness: surrogates are aggregated on the executors, and all but one of those
that meet, and any that is also a name of the corpus, are drawn again, with longer names, until none meets. Which
entities depart from their own first draw is joined back to the rows that mention them, however many there are.

Texts are searched once; what was found is staged beside them. Null texts stay null and empty ones empty; texts of any
length are searched whole; an empty table gives an empty result. Repeated rows are replaced alike, null ids stay null.
Other columns are ignored, whatever their names. The key is a parameter and must be kept secret in production.
"""

from __future__ import annotations

import hmac
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.tables import table
from siftwell.plans.staging import stage

KEY = b"change-me"
#: Forms of address by gender.
TITLES = {"m": ("Mr", "Sir", "Herr", "Señor", "Sr", "Don", "Monsieur", "г-н", "господин"), "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Sra", "Madame", "Mme", "г-жа", "госпожа"), "n": ("Dr", "Prof", "Mx")}
#: Words that introduce a name.
INTRODUCTIONS = ("my name is", "My name is", "mein Name ist", "Mein Name ist", "me llamo", "Me llamo", "je m'appelle", "Je m'appelle", "меня зовут", "Меня зовут")
#: Country calling codes of one and two digits; all others have three.
CALLING = ("1", "7", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_GENDER = {t: g for g, ts in TITLES.items() for t in ts}
_NAME = r"[^\W\d_][^\W\d_]*(?:[-'’][^\W\d_]+)*"
_TITLE = "|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True))
_INTRODUCED = "(?:" + "|".join(map(re.escape, INTRODUCTIONS)) + ")"
PATTERN = re.compile(
    r"(?P<email>[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[\x20.-]?(?:\(\d{1,4}\)[\x20.-]?)?\d{2,4}(?:[\x20.-]?\d{2,4}){1,4}(?!\d)|(?<![\w(])\(\d{3}\)\x20?\d{3}[\x20.-]\d{4}(?!\d)"
    r"|(?<![\w.+-])(?:\d{3}[.-]\d{3}[.-]\d{4}|\d{3}\x20\d{3}\x20\d{4}|0\d{1,4}[\x20/-]\d{3,4}(?:[\x20-]?\d{2,4}){1,2})(?![\w-]|\.\d))"
    r"|(?P<card>(?<![\d-])\d(?:[\x20-]?\d){12,18}(?![\d-]))"
    rf"|(?P<name>(?<!\w)(?:(?P<title>{_TITLE})\.?|{_INTRODUCED})\x20(?P<who>{_NAME}(?:\x20{_NAME}){{0,2}}))"
)
TYPES = ("email", "iban", "ssn", "ip", "phone", "card", "name")
#: What a text must have for any pattern to match.
_HINT = re.compile(rf"@|\d|(?<!\w)(?:(?:{_TITLE})\.?|{_INTRODUCED})\x20")


def _number(key: bytes, *parts: object) -> int:
    return int.from_bytes(hmac.digest(key, "\x1f".join(map(str, parts)).encode(), "sha256")[:8], "big")


def permuted(value: int, size: int, key: bytes, label: str) -> int:
    """A keyed permutation of range(size): Feistel rounds on an even number of bits, walked back into the range.

    Each run of fixed points, with the value after it, is shifted by one place first, so that no value stays what it is.
    """
    if size < 2:
        return value
    half = max(1, -(-(size - 1).bit_length() // 2))
    mask = (1 << half) - 1

    def walk(x: int) -> int:
        while True:
            left, right = x >> half, x & mask
            for r in range(6):
                left, right = right, left ^ (_number(key, label, size, r, right) & mask)
            x = left << half | right
            if x < size:
                return x

    out = walk(value)
    if out == value:
        return walk((value + 1) % size)
    first = value
    while walk((first - 1) % size) == (first - 1) % size:
        first = (first - 1) % size
    return out if first == value else first


_CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")


def by_pattern(text: str, key: bytes, label: str, fixed: int = 0) -> str:
    """``text`` with its letters and digits from ``fixed`` on replaced within their class, as one keyed permutation."""
    places = [(i, c) for i in range(fixed, len(text)) for c in _CLASSES if text[i] in c]
    value, size = 0, 1
    for i, c in places:
        value, size = value * len(c) + c.index(text[i]), size * len(c)
    shape = text[:fixed] + "".join(next((c[0] for c in _CLASSES if x in c), x) for x in text[fixed:])
    value = permuted(value, size, key, f"{label}:{shape}")
    out = list(text)
    for i, c in reversed(places):
        value, k = divmod(value, len(c))
        out[i] = c[k]
    return "".join(out)


def script_of(text: str) -> str:
    """The script of the first letter: one that has sounds here, or its block of 128 code points."""
    letter = next((c for c in text if c.isalpha()), "a")
    name = unicodedata.name(letter, "").split(" ")[0].lower()
    return name if name in _SOUNDS else f"{ord(letter) >> 7} {name}"


#: Consonants, vowels, and endings by gender, of scripts whose names tell it.
_SOUNDS = {
    "latin": ("bdfgklmnprstv", "aeiou", {"m": ("o", "on", "us"), "f": ("a", "ia", "ine"), "n": ("en", "is", "el")}),
    "cyrillic": ("бвгдклмнпрст", "аеиоу", {"m": ("ов", "ин", "ский"), "f": ("ова", "ина", "ская"), "n": ("енко", "их", "ко")}),
    "greek": ("βγδκλμνπρστ", "αειου", {"m": ("ος", "ης", "ας"), "f": ("α", "η", "ου"), "n": ("ι", "ακι", "ιδι")}),
}


@lru_cache(maxsize=None)
def _letters(script: str) -> str:
    """Letters of a script in a block of code points, without case, or the small ones."""
    block, name = script.split(" ")
    every = [chr(c) for c in range(int(block) << 7, (int(block) + 1) << 7) if unicodedata.category(chr(c)) in ("Lo", "Ll") and unicodedata.name(chr(c), "").lower().startswith(name)]
    return "".join(c for c in every if len(c.capitalize()) == 1 and c.capitalize().lower() == c)


def spelt(word: str, gender: str, key: bytes, draw: int) -> str:
    """A name of the word's script, gender and capitals; later draws are longer, so that there is always room."""
    script, n, out = script_of(word), int.from_bytes(hmac.digest(key, f"name\x1f{gender}\x1f{word}\x1f{draw}".encode(), "sha256"), "big"), ""
    if script not in _SOUNDS:
        letters = _letters(script)
        for _ in range(max(2, len(word)) + draw):
            n, a = divmod(n, len(letters))
            out += letters[a]
        return out
    consonants, vowels, endings = _SOUNDS[script]
    for _ in range(4 + draw):
        n, a = divmod(n, len(consonants))
        n, b = divmod(n, len(vowels))
        out += consonants[a] + vowels[b]
    return out + endings[gender][n % len(endings[gender])]


def _capital(word: str) -> bool:
    """Whether a word may be a name by its first letter; letters without case may."""
    return not word[0].islower()


def _caseless(word: str) -> bool:
    return word[0].upper() == word[0].lower()


def found(text: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Start, end, type, normal form and gender of each entity.

    A name found after a form of address is found again, whole or by one of its outer words, wherever the text has it;
    its normal form is the longest name of the text that it is part of, and its gender the first known one of that.
    """
    if not _HINT.search(text):
        return
    spans = list(_marked(text))
    names = [x for x in spans if x[2] == "name"]
    if not names:
        yield from spans
        return
    whole = sorted({x[3] for x in names}, key=lambda v: (-len(v.split(" ")), v))
    of = {v: v for v in whole}
    for v in whole:
        for part in (v.split(" ")[0], v.split(" ")[-1]):
            of[part] = min((w for w in whole if part in (w.split(" ")[0], w.split(" ")[-1])), key=whole.index)
    gender: dict[str, str] = {}
    for _, _, _, value, g in names:
        name = of[value]
        if gender.get(name, "n") == "n":
            gender[name] = g
    taken = sorted((x[0], x[1]) for x in spans)
    # Scripts without spaces have no ends of words.
    ended = lambda v: re.escape(v) if _caseless(v) and len(v) > 1 else rf"(?<!\w){re.escape(v)}(?!\w)"
    again = re.compile("|".join(map(ended, sorted(of, key=len, reverse=True))), re.IGNORECASE)
    at = 0
    for m in again.finditer(text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if all(map(_capital, m[0].split(" "))) and (at == len(taken) or taken[at][0] >= m.end()):
            spans.append((m.start(), m.end(), "name", m[0].lower(), ""))
    for start, end, kind, value, g in sorted(spans):
        if kind == "name":
            value = of.get(value, value)
            g = gender[value]
        yield start, end, kind, value, g


def _marked(text: str) -> Iterator[tuple[int, int, str, str, str]]:
    """The entities that the pattern finds by itself."""
    for m in PATTERN.finditer(text):
        kind = m.lastgroup if m.lastgroup in TYPES else "name"
        if kind == "name":
            words = m["who"].split(" ")
            n = next((i for i, w in enumerate(words) if not _capital(w) or _caseless(w) != _caseless(words[0])), len(words))
            n = min(n, 2) if _caseless(words[0]) else n
            if n:
                who = re.sub(r"['’][sS]$", "", " ".join(words[:n]))
                yield m.start("who"), m.start("who") + len(who), kind, who.lower(), _GENDER[m["title"]] if m["title"] else "n"
        elif kind == "email":
            yield m.start(), m.end(), kind, m[0].lower(), ""
        elif kind == "ip":
            yield m.start(), m.end(), kind, m[0], ""
        else:
            yield m.start(), m.end(), kind, ("+" if m[0][0] == "+" else "") + re.sub(r"[^0-9A-Z]", "", m[0]), ""


@lru_cache(maxsize=100_000)
def surrogate(kind: str, value: str, gender: str, key: bytes, draw: int = 0) -> str:
    """The replacement's normal form."""
    label = f"{kind}:{draw}" if draw else kind
    if kind == "name":
        return " ".join(spelt(w, gender or "n", key, draw) for w in value.split(" "))
    if kind == "email":
        local, _, domain = value.rpartition("@")
        name, _, top = domain.rpartition(".")
        return f"{by_pattern(local, key, f'{label}:{domain}')}@{by_pattern(name, key, 'domain')}.{top}"
    if kind == "ip":
        octets = value.split(".")
        n = permuted(int.from_bytes(bytes(map(int, octets)), "big"), 1 << 32, key, label)
        return ".".join(map(str, n.to_bytes(4, "big")))
    if kind == "card":
        rest = by_pattern(value[:-1], key, label)
        return rest + str((int(value[-1]) - _luhn(value[:-1]) + _luhn(rest)) % 10)
    if kind == "iban":
        rest = by_pattern(value[4:], key, f"{label}:{value[:2]}")
        was, now = (98 - _mod97(x + value[:2] + "00") for x in (value[4:], rest))
        check = int(value[2:4])
        return f"{value[:2]}{now if check == was else 2 + (check - was + now - 2) % 97:02d}{rest}"
    if value[0] == "+":
        return by_pattern(value, key, label, 1 + next((len(c) for c in CALLING if value[1:].startswith(c)), 3))
    return by_pattern(value, key, label, 1 if kind == "phone" and value[0] == "0" else 0)


def _luhn(digits: str) -> int:
    """The check digit of a card number without it."""
    doubled = [2 * int(c) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(digits))]
    return -sum(d - 9 if d > 9 else d for d in doubled) % 10


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def dressed(mention: str, kind: str, form: str, value: str = "") -> str:
    """A surrogate's normal form in the format of the mention that it replaces."""
    if kind == "ip":
        return form
    if kind == "name":
        words = mention.split(" ")
        if value and value != mention.lower():
            of = dict(zip(value.split(" "), form.split(" "), strict=True))
            form = " ".join(of[w.lower()] for w in words)
        return " ".join(f.upper() if w.isupper() and len(w) > 1 else f.capitalize() if w[0].isupper() else f for w, f in zip(words, form.split(" "), strict=True))
    if kind == "email":
        return "".join(f.upper() if c.isupper() else f for c, f in zip(mention, form, strict=True))
    rest = iter(form.removeprefix("+"))
    return "".join(next(rest) if c.isascii() and c.isalnum() else c for c in mention)


Span = tuple[int, int, str, str, str]
Departures = dict[tuple[str, str, str], tuple[str, int]]


def replaced(text: str, spans: list[Span], key: bytes, departures: Departures | None = None) -> str:
    """The text with surrogates of its spans; ``departures`` has gender and draw of entities that do not have their own first."""
    out, at = [], 0
    for start, end, kind, value, gender in spans:
        form = surrogate(kind, value, *_drawn(kind, value, gender, key, departures))
        out += [text[at:start], dressed(text[start:end], kind, form, value)]
        at = end
    return "".join([*out, text[at:]])


def _drawn(kind: str, value: str, gender: str, key: bytes, departures: Departures | None) -> tuple[str, bytes, int]:
    gender, draw = (departures or {}).get((kind, value, gender), (gender, 0))
    return gender, key, draw


def replace(text: str, key: bytes, departures: Departures | None = None) -> tuple[str, list[str]]:
    """The text with surrogates, and the types that were replaced, in order."""
    spans = list(found(text))
    return replaced(text, spans, key, departures), [x[2] for x in spans]


SPANS = "array<struct<start:int,end:int,kind:string,value:string,gender:string>>"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string()), ("gender", pa.string())])


def detected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (a number), doc_id, text and spans of each row, staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in _SPAN]
        for batch in batches:
            held = [[dict(zip(names, x, strict=True)) for x in found(t)] if t else [] for t in (x.as_py() for x in batch.column(1))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(held, pa.list_(_SPAN))], names=["doc_id", "text", "spans"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stage(slim.mapInArrow(run, f"doc_id long, text string, spans {SPANS}").withColumn("row", F.monotonically_increasing_id()), "detected")


def _with_forms(rows: DataFrame, key: bytes) -> DataFrame:
    """kind, value, gender, draw and the surrogate's normal form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = [surrogate(r["kind"], r["value"], r["gender"], key, r["draw"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forms, pa.string())], names=[*batch.schema.names, "form"])

    return rows.select("kind", "value", "gender", "draw").mapInArrow(run, "kind string, value string, gender string, draw int, form string")


def settled(mentions: DataFrame, key: bytes) -> DataFrame:
    """kind, value, gender as mentioned, with the gender and draw that keep surrogates distinct and apart from real names.

    Of entities whose surrogates meet, the one with the fewest draws, then the smallest, keeps its own; the others draw
    again. Draws get longer, so this ends.
    """
    own = stage(mentions.select("kind", "value", "gender").distinct(), "entities")
    told = own.where("kind = 'name' AND gender <> 'n'").groupBy("kind", "value").agg(F.min("gender").alias("lo"), F.max("gender").alias("hi"))
    told = told.where("lo = hi").select("kind", "value", F.col("lo").alias("told"))
    named = stage(own.join(told, ["kind", "value"], "left").withColumn("as", F.coalesce("told", "gender")).drop("told"), "genders")
    persons = stage(_with_forms(named.select("kind", "value", F.col("as").alias("gender"), F.lit(0).alias("draw")).distinct(), key), "forms")
    real = own.where("kind = 'name'").select("kind", F.col("value").alias("form")).distinct()
    while True:
        turn = F.struct("draw", "value", "gender")
        met = persons.groupBy("kind", "form").agg(F.min(turn).alias("owner"), F.count("*").alias("n")).where("n > 1").drop("n")
        losers = persons.join(met, ["kind", "form"]).where(turn != F.col("owner")).drop("owner")
        lost = stage(losers.unionByName(persons.join(real, ["kind", "form"], "left_semi")).distinct(), "met")
        if lost.isEmpty():
            break
        keep = persons.join(lost.select("kind", "value", "gender"), ["kind", "value", "gender"], "left_anti")
        persons = stage(keep.unionByName(_with_forms(lost.withColumn("draw", F.col("draw") + 1), key)), "forms")
    chosen = persons.select("kind", "value", F.col("gender").alias("as"), "draw")
    return named.join(chosen, ["kind", "value", "as"]).select("kind", "value", "gender", "as", "draw")


def pseudonymize(docs: DataFrame, key: bytes = KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row: doc_id, text, n_entities and entity_types (their types in order)."""
    rows = detected(docs, id_col, text_col)
    mentions = rows.select("row", F.explode("spans").alias("x")).select("row", "x.kind", "x.value", "x.gender")
    apart = stage(settled(mentions, key).where("draw > 0 OR as <> gender"), "departures")
    if apart.isEmpty():
        wide = rows.withColumn("departures", F.lit(None).cast("array<struct<kind:string,value:string,gender:string,as:string,draw:int>>"))
    else:
        each = mentions.join(apart, ["kind", "value", "gender"]).groupBy("row").agg(F.collect_set(F.struct("kind", "value", "gender", "as", "draw")).alias("departures"))
        wide = rows.join(each, "row", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for i, held in enumerate(batch.column(2)):
                text = batch.column(1)[i].as_py()
                if len(held):
                    own = {(d["kind"], d["value"], d["gender"]): (d["as"], d["draw"]) for d in batch.column(3)[i].as_py() or []}
                    text = replaced(text, [tuple(x.values()) for x in held.as_py()], key, own)
                texts.append(text)
            kinds = [",".join(x["kind"] for x in held.as_py()) for held in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([len(h) for h in batch.column(2)], pa.int64()), pa.array(kinds, pa.string())], names=["doc_id", "text", "n_entities", "entity_types"])

    return wide.select("doc_id", "text", "spans", "departures").mapInArrow(run, "doc_id long, text string, n_entities long, entity_types string")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(table(spark, sf_dir, "documents"))
