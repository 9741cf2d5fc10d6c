"""PII surrogates: entities get keyed replacements of their own kind and format, the same entity always the same one.

A replacement is the next element on a keyed cycle through all values of the entity's
format, so within a format it never is the entity itself and two entities never share it. Given
names stay within their gender and script, letters within vowels or consonants of their script.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from hashlib import blake2b
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import stored, table, texts

KEY = "surrogate-key"
ROUNDS = 8
#: Replacements that had to be drawn again are broadcast up to this number and joined beyond it.
MAX_SENT = 20_000

# Given names by script and gender, titles by gender.
GIVEN_NAMES = {
    ("latin", "f"): "Anna Maria Laura Julia Sofia Emma Clara Lucia Elena Marta Sarah Emily Alice Camille Chloe Heidi Ingrid Petra Carmen Isabel Olivia Hannah Charlotte Amelia".split(),
    ("latin", "m"): "Peter Thomas Michael David Daniel Martin Lucas Pablo Carlos Diego James John Robert William Henri Louis Pierre Hans Klaus Stefan Miguel Oliver George Edward".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия".split(),
    ("cyrillic", "m"): "Иван Алексей Дмитрий Сергей Андрей Михаил Николай Павел Владимир Юрий".split(),
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Σοφία Αννα Ιωάννα".split(),
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης Παύλος".split(),
}
TITLES = {"f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"], "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"]}

# Characters of an IBAN by country; others end where their groups do.
IBAN_SIZES = {c: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH DE GB GE IE ME RS", 23: "AE GI IL",
    24: "AD CZ ES MD PK RO SA SE SK TN VA", 25: "PT", 26: "IS TR", 27: "FR GR IT MC SM", 28: "AL AZ CY DO HU LB PL", 29: "BR QA UA", 31: "MT",
}.items() for c in codes.split()}

# Letter classes whose members stand in for each other.
LETTERS = ["aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóú", "àèìòù", "âêîôû", "äöü", "аеёиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αεηιουω", "άέήίόύώ", "βγδζθκλμνξπρστφχψ"]

_LETTER_CLASS = {c: letters for letters in LETTERS for c in letters}


def letter_class(c: str) -> str:
    """The characters that stand in for ``c``: of its class above, or else those of its kind near it in its script; '' for signs."""
    if c in _LETTER_CLASS or not c.isalnum():
        return _LETTER_CLASS.get(c, "")
    for width in (32, 256):
        first = ord(c) // width * width
        near = "".join(x for x in map(chr, range(first, first + width)) if unicodedata.category(x) == unicodedata.category(c) and x.isalnum() and x.lower() == x)
        if c in near and len(near) > 1:
            _LETTER_CLASS[c] = near  # at most one entry for each character there is
            return near
    return ""

_GIVEN = {name.lower(): (pool, i) for pool in GIVEN_NAMES.values() for i, name in enumerate(pool)}
_TITLE = "|".join(t for group in TITLES.values() for t in group)

_CAPITAL = "[A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΫА-ЯЁ][a-zß-öø-ÿά-ώа-яё]+"
#: Phone numbers with a country: in the usual four parts, and in any parts of 8 to 15 digits in all.
_NATIONAL = r"\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3}[ .-]?\d{3,4}"
_ABROAD = r"\+\(?\d(?:[ .-]?[()]?[ .-]?\d){7,14}"
#: Letters and digits, with the marks that belong to letters of Hebrew, Arabic, Indic, Thai and Lao scripts.
_W = r"\w\u0300-\u036F\u0591-\u05C7\u0610-\u065F\u0900-\u0EFF"
_SPOTTED = re.compile(
    rf"(?P<email>[{_W}.+-]+@[{_W}-]+(?:\.[{_W}-]+)+)"
    r"|(?i:\b(?:token|key|secret|password|passwd|api_key)\b\s*[:=]\s*[\"']?)(?P<secret>[A-Za-z0-9_\-]{12,})"
    r"|(?<![\w.])(?P<ip>(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d))(?![\w]|\.\d)"
    r"|(?<!\w)(?P<iban>[A-Z]{2}\d{2}(?=(?: ?[A-Z0-9]){11})(?: ?[A-Z0-9]{4}){2,7}(?:[A-Z0-9]{1,3}| (?=[A-Z]*\d)[A-Z0-9]{1,3})?)(?!\w)"
    rf"|(?<![\w+])(?P<phone>{_NATIONAL}(?![ .-]?\d)|{_ABROAD}(?![ .-]?\d)|{_NATIONAL}(?!\d)|{_ABROAD}(?!\d)|\(\d{{3}}\) ?\d{{3}}-\d{{4}}(?!\d)|\d{{3}}[.-]\d{{3}}[.-]\d{{4}}(?!\d))"
    r"|(?<!\d)(?P<ssn>\d{3}-\d{2}-\d{4})(?!\d)"
    r"|(?<!\d)(?P<card>\d(?:[ -]?\d){12,18})(?!\d)"
)
_NAMED = re.compile(rf"(?<!\w)(?:(?P<title>{_TITLE})\.? )?(?P<words>{_CAPITAL}(?: {_CAPITAL})*)")
_MAY_SPOT = re.compile(r"[\d@]|(?i:token|key|secret|pass)")


def _number(key: str, *parts: object) -> int:
    return int.from_bytes(blake2b(repr(parts).encode(), key=blake2b(key.encode(), digest_size=32).digest(), digest_size=32).digest(), "big")


def _permute(key: str, label: str, size: int, value: int, back: bool = False) -> int:
    """A keyed permutation of 0..size-1: a Feistel network over a square that holds them, walked until it lands inside."""
    side = isqrt(size - 1) + 1
    while True:
        a, b = divmod(value, side)
        for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                a, b = (b - _number(key, label, r, a)) % side, a
            else:
                a, b = b, (a + _number(key, label, r, b)) % side
        value = a * side + b
        if value < size:
            return value


def next_on_cycle(key: str, label: str, size: int, value: int) -> int:
    """The successor of ``value`` on a keyed cycle through 0..size-1: one to one, and no value is its own."""
    if size < 2:
        return value
    return _permute(key, label, size, (_permute(key, label, size, value, back=True) + 1) % size)


def _by_classes(key: str, label: str, text: str, classes: list[str]) -> str:
    """``text`` with the characters that have a class exchanged for others of it, together as one number."""
    size, value = 1, 0
    for c, letters in zip(text, classes):
        if letters:
            size, value = size * len(letters), value * len(letters) + letters.index(c)
    value = next_on_cycle(key, f"{label}/{'/'.join(letters[:1] for letters in classes)}/{size}", size, value)
    out = []
    for c, letters in zip(reversed(text), reversed(classes)):
        if letters:
            value, at = divmod(value, len(letters))
            c = letters[at]
        out.append(c)
    return "".join(reversed(out))


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def canonical(kind: str, value: str) -> str:
    """What makes two mentions the same entity: no case for addresses and names, digits only for numbers."""
    if kind in ("card", "phone", "ssn"):  # of any script
        return "".join(str(unicodedata.decimal(c)) for c in value if c.isdecimal())
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "secret" and (value.upper() == value or value.lower() == value):
        return value.lower()
    return value.lower() if kind in ("email", "name", "surname", "given") else value


def replacement(kind: str, entity: str, attempt: int = 0, key: str = KEY) -> str:
    """The surrogate of a canonical entity; another ``attempt`` gives another one."""
    label = f"{kind}#{attempt}"
    digits = "0123456789"
    if kind == "ip":
        a, b, c, d = map(int, entity.split("."))
        value = next_on_cycle(key, label, 1 << 32, (a << 24) | (b << 16) | (c << 8) | d)
        return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))
    if kind == "card":
        body = _by_classes(key, label, entity[:-1], [digits] * (len(entity) - 1))
        return body + str((_luhn(body) + int(entity[-1]) - _luhn(entity[:-1])) % 10)
    if kind in ("phone", "ssn"):
        keep = max(0, len(entity) - 10)  # the country
        return _by_classes(key, label, entity, [""] * keep + [digits] * (len(entity) - keep))
    if kind == "iban":
        upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        return _by_classes(key, label, entity, ["", "", *[digits if c.isdigit() else upper for c in entity[2:]]])
    if kind == "secret":
        hexa = "0123456789abcdef"
        if all(c in hexa for c in entity):
            return _by_classes(key, label, entity, [hexa] * len(entity))
        lower = "abcdefghijklmnopqrstuvwxyz"
        return _by_classes(key, label, entity, [digits if c.isdigit() else lower if c in lower else lower.upper() if c in lower.upper() else "" for c in entity])
    if kind == "email":
        stop = entity.rindex(".")
        out = _by_classes(key, label, entity, [digits if c in digits else letter_class(c) if i < stop else "" for i, c in enumerate(entity)])
        if out != entity:
            return out
        number = _number(key, label, entity)  # an address of signs only has no other of its form
        return "".join(chr(97 + (number >> 8 * k) % 26) for k in range(8)) + "@" + chr(97 + (number >> 64) % 26) + entity[stop:]
    if kind == "given":
        pool, at = _GIVEN[entity]
        return pool[next_on_cycle(key, f"{label}/{pool[0]}", len(pool), at)].lower()
    return _by_classes(key, label, entity, [letter_class(c) for c in entity])


def dressed(kind: str, original: str, surrogate: str) -> str:
    """The surrogate with the separators and the case of the mention."""
    if kind in ("card", "phone", "ssn", "iban"):
        left = iter(surrogate)
        # digits of another script stay in it
        return "".join(next(left) if c.isascii() and c.isalnum() else chr(ord(c) - unicodedata.decimal(c) + int(next(left))) if c.isdecimal() else c for c in original)
    if kind in ("name", "surname", "given"):
        return " ".join(w.upper() if o.isupper() and len(o) > 1 else w[:1].upper() + w[1:] for o, w in zip(original.split(" "), surrogate.split(" ")))
    if kind == "secret":
        return surrogate.upper() if original.upper() == original and original.lower() != original else surrogate
    if kind == "email" and original != original.lower() and len(original) == len(surrogate):
        return "".join(s.upper() if o.isupper() else s for o, s in zip(original, surrogate))
    return surrogate


def _iban_end(value: str) -> int:
    """Where the number ends: after the characters of its country if a blank follows them, as words in capitals may follow."""
    at = [i for i, c in enumerate(value) if c != " "]
    size = IBAN_SIZES.get(value[:2], len(at))
    return at[size] - 1 if size < len(at) and value[at[size] - 1] == " " else len(value)


def entities(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the entities of a text, in order and without overlap.

    A name is a title with capitalised words, or a known given name with at least one more;
    its first word is ``given`` if known, the others are ``surname``.
    """
    found = []
    if _MAY_SPOT.search(text):
        for m in _SPOTTED.finditer(text):
            kind = m.lastgroup
            if kind == "card" and not 13 <= len(canonical(kind, m[kind])) <= 19:
                continue
            start, end = m.span(kind)
            found.append((start, _iban_end(m[kind]) + start if kind == "iban" else end, kind))
    taken = [(a, b) for a, b, _ in found]
    for m in _NAMED.finditer(text):
        start, kind = m.start("words"), ""
        names = m["words"].split(" ")
        if not m["title"]:
            known = next((i for i, w in enumerate(names[:-1]) if w.lower() in _GIVEN), None)
            if known is None:
                continue
            start += sum(len(w) + 1 for w in names[:known])
            names = names[known:]
        kind = "surname"
        if names[0].lower() in _GIVEN:
            kind = "name" if len(names) > 1 else "given"
        end = start + len(" ".join(names))
        if not any(a < end and start < b for a, b in taken):
            found.append((start, end, kind))
    return sorted(found)


def replaced(text: str, attempts: dict[tuple[str, str], int], key: str = KEY) -> tuple[str, int]:
    """The text with surrogates and the number of entities; ``attempts`` names those that were drawn again."""
    out, last, spots = [], 0, entities(text)
    for start, end, kind in spots:
        parts = [replacement(k, e, attempts.get((k, e), 0), key) for k, e in parts_of(kind, canonical(kind, text[start:end]))]
        out += [text[last:start], dressed(kind, text[start:end], " ".join(parts))]
        last = end
    return "".join([*out, text[last:]]), len(spots)


def parts_of(kind: str, entity: str) -> list[tuple[str, str]]:
    """``(kind, entity)`` of what is replaced on its own: a name is its given name and its surnames, so that both are the same wherever they stand."""
    if kind not in ("name", "surname"):
        return [(kind, entity)]
    first, *rest = entity.split(" ")
    return [("given" if kind == "name" else "surname", first), *[("surname", w) for w in rest]]


def mentioned(docs: DataFrame) -> DataFrame:
    """``doc_id, kind, entity``: the entities of every document, once each, names by their parts."""

    @F.pandas_udf("array<struct<kind:string,entity:string>>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([sorted({p for a, b, k in entities(t) for p in parts_of(k, canonical(k, t[a:b]))}) for t in batch])

    return texts(docs).select("doc_id", F.explode(of("text")).alias("e")).select("doc_id", "e.kind", "e.entity")


def drawn_again(found: DataFrame, key: str = KEY, rounds: int = 20) -> DataFrame:
    """``kind, entity, attempt`` of the entities whose first surrogate collides.

    A surrogate collides if another entity has it or if it is itself an entity of the
    corpus; all but one of those that share it draw again until nothing collides. Given names
    and surnames, of which there are few, are exempt: they stay one to one by the cycle, and so do whole names.
    """

    @F.pandas_udf("string")
    def drawn(kinds: pd.Series, values: pd.Series, attempts: pd.Series) -> pd.Series:
        return pd.Series([replacement(k, v, int(n), key) for k, v, n in zip(kinds, values, attempts)])

    known = stored(found.where(~F.col("kind").isin("given", "surname")).select("kind", "entity").distinct(), "entities")
    state = known.withColumn("attempt", F.lit(0))
    for _ in range(rounds):
        state = stored(state.select("kind", "entity", "attempt").withColumn("s", drawn("kind", "entity", "attempt")), "surrogates")
        real = state.join(known.select(F.col("kind").alias("k"), F.col("entity").alias("s0")), (F.col("kind") == F.col("k")) & (F.col("s") == F.col("s0")), "left_semi")
        first = state.groupBy("kind", "s").agg(F.min(F.struct(-F.col("attempt"), "entity")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        shared = state.join(first, ["kind", "s"]).where(F.col("entity") != F.col("first.entity"))
        losers = stored(real.select("kind", "entity").unionByName(shared.select("kind", "entity")).distinct(), "collisions")
        if losers.isEmpty():
            return state.where("attempt > 0").select("kind", "entity", "attempt")
        hit = losers.withColumn("again", F.lit(1))
        state = state.join(hit, ["kind", "entity"], "left").select("kind", "entity", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt"))
    raise ValueError(f"surrogates still collide after {rounds} draws")


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``doc_id, text, n_entities`` for every row, with all entities replaced.

    Null texts become empty texts. Repeated rows get equal texts, null ids stay. Whether
    a surrogate had to be drawn again is looked up in a small list sent to the tasks, or, beyond
    ``MAX_SENT`` such entities, in a list per document. No rows: no rows.
    """
    found = stored(mentioned(docs), "mentions")
    again = stored(drawn_again(found, key), "drawn-again")

    @F.pandas_udf("text string, n int")
    def with_sent(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([replaced(t, sent.value, key) for t in batch], columns=["text", "n"])

    @F.pandas_udf("text string, n int")
    def with_own(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for batch, own in batches:
            lists = [{} if e is None else {(x["kind"], x["entity"]): x["attempt"] for x in e} for e in own]
            yield pd.DataFrame([replaced(t, a, key) for t, a in zip(batch, lists)], columns=["text", "n"])

    rows = texts(docs)
    if again.count() <= MAX_SENT:
        sent = docs.sparkSession.sparkContext.broadcast({(r["kind"], r["entity"]): r["attempt"] for r in again.collect()})
        out = rows.select("doc_id", with_sent("text").alias("r"))
    else:
        own = found.join(again, ["kind", "entity"]).groupBy(F.col("doc_id").alias("i")).agg(F.collect_set(F.struct("kind", "entity", "attempt")).alias("own"))
        out = rows.join(own, rows["doc_id"].eqNullSafe(own["i"]), "left").select("doc_id", with_own("text", "own").alias("r"))
    return out.select("doc_id", "r.text", F.col("r.n").alias("n_entities"))


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"))
