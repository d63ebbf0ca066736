"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

Detected: e-mail addresses, phone numbers, payment card numbers, IPv4 addresses, US social security numbers,
IBANs, access keys, secrets after ``password=``, ``token = "`` and the like (up to white space or the closing quote),
and persons: a given name of a list with the surname after it in the same script, a capitalised name after a title
(``Mr.``, ``Frau`` and the like), and every other place of the text where a surname so found stands alone.

A surrogate is the entity under a keyed permutation of its own format class: digits stay digits, small letters
small letters, capitals capitals, separators stay where they are; card numbers keep the validity of their check
digit, octets stay octets, a given name goes to another of its gender and script, and a surname keeps script,
capitals and a gendered ending.  The permutation is a balanced Feistel network keyed by HMAC-SHA256; surnames without
a listed ending are permuted again until the result has none either, so surnames with and without one never meet.
Thus within a type two entities never share a surrogate, and an entity has one surrogate wherever it stands (e-mail
addresses and hexadecimal secrets whatever their case, phone numbers whatever their punctuation, a surname with or
without the given name): coreference holds with no table of names, and no shuffle.  ``collisions`` checks both
properties over a whole corpus.

Null texts stay null, empty texts empty; rows are kept one for one, repeated ones too.  The column of entities replaces
one of the same name.
"""

from __future__ import annotations

import hashlib
import hmac
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import settle, widened
from cinerank.session import remove_path

# Given names by script and gender.
GIVEN = {
    ("latin", "f"): ["Alice", "Anna", "Barbara", "Carmen", "Charlotte", "Claire", "Elena", "Elizabeth", "Emma", "Hannah", "Ingrid", "Isabel", "Jennifer", "Julia", "Karen", "Laura", "Linda", "Lucia", "Maria", "Marie", "Mary", "Nancy", "Olivia", "Patricia", "Sarah", "Sofia", "Sophie", "Susan"],
    ("latin", "m"): ["Andreas", "Antonio", "Carlos", "Charles", "Daniel", "David", "François", "Hans", "Henri", "Jacques", "James", "Javier", "John", "José", "Jürgen", "Karl", "Klaus", "Louis", "Luis", "Michael", "Miguel", "Paul", "Peter", "Pierre", "Robert", "Stefan", "Thomas", "William"],
    ("cyrillic", "f"): ["Анна", "Екатерина", "Елена", "Ирина", "Мария", "Наталья", "Ольга", "Татьяна"],
    ("cyrillic", "m"): ["Александр", "Алексей", "Дмитрий", "Иван", "Михаил", "Николай", "Павел", "Сергей"],
    ("greek", "f"): ["Αικατερίνη", "Ελένη", "Μαρία", "Σοφία"],
    ("greek", "m"): ["Γεώργιος", "Δημήτριος", "Ιωάννης", "Νικόλαος"],
}
# Surname endings that show gender.
ENDINGS = ("ская", "ский", "ова", "ева", "ёва", "ина", "ов", "ев", "ёв", "ин", "ová", "ova", "ska", "ski", "ού", "ος")
# The alphabets of the permutation; a character outside of them stays.
ALPHABETS = (
    "0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "àâäáéèêëíìîïóòôöúùûü", "ñçß",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъь", "АЕЁИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩЪЬ", "αεηιουω", "βγδζθκλμνξπρστφχψς", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ",
)
_PLAIN = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", *ALPHABETS[5:])
_HEX = ("0123456789abcdef",)
ROUNDS = 8

# Titles that a name follows.
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Mlle", "Señor", "Señora", "Sr", "Sra", "Г-н", "Г-жа", "Κος", "Κα")

_NAMES = "|".join(sorted((n for v in GIVEN.values() for n in v), key=lambda n: (-len(n), n)))
_SURNAME = r"[^\W\d_]{2,}(?:-[^\W\d_]+)?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: The first alternative that matches at a place names the type.
PATTERN = re.compile(
    r"(?P<email>[^\W_](?:[\w.%+-]*[\w%+-])?@[^\W_](?:[^\W_]|-(?=[^\W_]|-))*(?:\.[^\W_](?:[^\W_]|-(?=[^\W_]|-))*)+)"
    rf"|(?P<ipv4>(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<!\d)\d{4}(?P<gap>[ -]?)\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}(?!\d))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d)|(?<!\w)\+\d{8,15}(?!\d))"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<access_key>\b(?:AKIA|ASIA)[A-Z0-9]{16}\b)"
    r"|(?i:password|passwd|pwd|api[_-]?key|secret|token)[\"']?\s{0,3}[:=]\s{0,3}(?:\"(?P<quoted>[^\"\s]{6,})|'(?P<single>[^'\s]{6,})|(?P<secret>[^\s\"'][^\s\"']{4,}[^\s\"'.,;:?)\]}>]))"
    rf"|(?P<person>\b(?:{_NAMES})\b[ \u00a0](?:[A-Z]\. )?{_SURNAME})"
    rf"|\b(?:{'|'.join(TITLES)})\b\.?[ \u00a0](?P<surname>{_SURNAME})"
)
#: One of these is in every text with an entity.
_HINT = re.compile(rf"[0-9@]|AKIA|ASIA|(?i:password|passwd|pwd|api[_-]?key|secret|token)|\b(?:{_NAMES}|{'|'.join(TITLES)})\b")


def _ending(name: str) -> str:
    """The listed ending of a surname, if a stem of three letters or more stands before it."""
    return next((e for e in ENDINGS if name.endswith(e) and len(name) - len(e) > 2), "")


class Surrogates:
    """Keyed permutations of the format classes; equal keys give equal surrogates."""

    def __init__(self, key: bytes):
        self.key, self.memo = key, {}

    def _numbers(self, tweak: str, k: int, half: list[int], n: int) -> list[int]:
        seed = hmac.new(self.key, f"{tweak}|{k}|{n}|{half}".encode(), hashlib.sha256).digest()
        out = hashlib.shake_128(seed).digest(8 * n)
        return [int.from_bytes(out[8 * i:8 * i + 8], "little") for i in range(n)]

    def permute(self, tweak: str, values: list[int], sizes: list[int]) -> list[int]:
        """Another sequence of numbers under ``sizes``; a bijection for each tweak and list of sizes."""
        cut = len(values) // 2
        a, b, sa, sb = values[:cut], values[cut:], sizes[:cut], sizes[cut:]
        for k in range(ROUNDS):
            if k % 2:
                a = [(x + y) % s for x, y, s in zip(a, self._numbers(tweak, k, b, len(a)), sa, strict=True)]
            else:
                b = [(x + y) % s for x, y, s in zip(b, self._numbers(tweak, k, a, len(b)), sb, strict=True)]
        return a + b

    def _letters(self, tweak: str, text: str, alphabets=_PLAIN, fold: bool = False) -> str:
        """The text with each character of an alphabet moved inside it; ``fold``: whatever the letters' case."""
        seen = text.lower() if fold and len(text.lower()) == len(text) else text
        at, values, sizes, of = [], [], [], []
        for i, c in enumerate(seen):
            a = next((a for a in alphabets if c in a), None)
            if a:
                at.append(i), values.append(a.index(c)), sizes.append(len(a)), of.append(a)
        out = list(seen)
        form = [c for c in seen if not any(c in a for a in alphabets)]
        for i, v, a in zip(at, self.permute(f"{tweak}|{sizes}|{form}", values, sizes), of, strict=True):
            out[i] = a[v]
        return "".join(c.upper() if seen is not text and o != o.lower() and len(c.upper()) == 1 else c for c, o in zip(out, text, strict=True))

    def _digits(self, tweak: str, text: str, skip: int = 0, last: int = 0) -> str:
        """The digits, without the first ``skip`` and the last ``last`` of them, moved; all else in place."""
        at = [i for i, c in enumerate(text) if c in "0123456789"]
        at = at[skip:len(at) - last]
        out = list(text)
        for i, v in zip(at, self.permute(f"{tweak}|{len(at)}", [int(text[i]) for i in at], [10] * len(at)), strict=True):
            out[i] = str(v)
        return "".join(out)

    def _card(self, text: str) -> str:
        luhn = lambda t: -sum(sum(divmod(d * (1 + k % 2), 10)) for k, d in enumerate(int(c) for c in reversed(t) if c.isdigit())) % 10
        new = self._digits("card", text, last=1)
        # the last digit keeps its distance from a valid one
        body, tail = text[:-1], int(text[-1])
        want = lambda t: luhn(t + "0")
        return new[:-1] + str((want(new[:-1]) + tail - want(body)) % 10)

    def _phone(self, text: str) -> str:
        n = sum(c.isdigit() for c in text)
        skip = max(0, n - 10) if text.startswith("+") or n > 10 else 0
        return self._digits(f"phone|{min(n, 10)}", text, skip)

    def _iban(self, text: str) -> str:
        flat = text.replace(" ", "")
        body = self._letters("iban", flat[4:])
        number = "".join(str(int(c, 36)) for c in body + flat[:2] + "00")
        old = int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97
        new = flat[:2] + (f"{98 - int(number) % 97:02d}" if old == 1 else self._digits(f"iban|{body}", flat[2:4])) + body
        out, it = list(text), iter(new)
        return "".join(c if c == " " else next(it) for c in out)

    def _given(self, name: str) -> str:
        """The next name of its list in an order that the key gives: another one, and a bijection."""
        (script, gender), names = next((k, v) for k, v in GIVEN.items() if name in v)
        order = sorted(names, key=lambda n: hmac.new(self.key, f"given|{script}|{gender}|{n}".encode(), hashlib.sha256).digest())
        return order[(order.index(name) + 1) % len(order)]

    def _surname(self, name: str) -> str:
        end = _ending(name)
        if end:
            return self._letters(f"surname|{end}", name[:-len(end)], ALPHABETS) + end
        out = self._letters("surname|", name, ALPHABETS)
        while _ending(out):  # walks on along the permutation, back to a name without an ending
            out = self._letters("surname|", out, ALPHABETS)
        return out

    def _person(self, text: str) -> str:
        given = re.match(rf"(?:{_NAMES})\b", text)[0]
        surname = text.split()[-1]
        between = text[len(given):len(text) - len(surname)]
        return self._given(given) + self._letters(f"initial|{surname}", between, ALPHABETS) + self.make("surname", surname)

    def make(self, kind: str, text: str) -> str:
        got = self.memo.get((kind, text))
        if got is None:
            if len(self.memo) > 100_000:
                self.memo.clear()
            got = self.memo[kind, text] = self._make(kind, text)
        return got

    def _make(self, kind: str, text: str) -> str:
        if kind == "email":
            local, _, domain = text.rpartition("@")
            stem, dot, top = domain.rpartition(".")
            reserved = re.search(r"(?i)(?:^|\.)example$", stem)
            cut = reserved.start() if reserved else len(stem)
            return self._letters("local", local, fold=True) + "@" + self._letters("domain", stem[:cut], fold=True) + stem[cut:] + dot + top
        if kind == "ipv4":
            return ".".join(map(str, self.permute("ipv4", [int(x) for x in text.split(".")], [256] * 4)))
        if kind == "ssn":
            return self._digits("ssn", text)
        if kind == "card":
            return self._card(text)
        if kind == "phone":
            return self._phone(text)
        if kind == "iban":
            return self._iban(text)
        if kind == "access_key":
            return text[:4] + self._letters("access_key", text[4:], ("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",))
        if kind == "secret":
            return self._letters("hex", text, _HEX, fold=True) if re.fullmatch(r"(?i)[0-9a-f]+", text) else self._letters("secret", text)
        if kind == "surname":
            return self._surname(text)
        return self._person(text)


def canonical(kind: str, text: str) -> str:
    """What counts as one entity: case and punctuation that the format class ignores are dropped."""
    if kind in ("card", "iban", "ssn"):
        return re.sub(r"[ -]", "", text)
    if kind == "phone":
        return "".join(c for c in text if c.isdigit())[-10:]
    if kind == "email" or kind == "secret" and re.fullmatch(r"(?i)[0-9a-f]+", text):
        return text.lower()
    return text


def _is_name(word: str) -> bool:
    return word[0].isupper() and not word.isupper()


def find(text: str):
    """(kind, start, end) of the entities of a text, from left to right."""
    if not _HINT.search(text):
        return []
    out, surnames = [], set()
    for m in PATTERN.finditer(text):
        kind = m.lastgroup
        if kind == "person":
            given, surname = re.match(rf"(?:{_NAMES})\b", m[0])[0], m[0].split()[-1]
            if not surname[0].isupper() or (ord(given[-1]) < 0x250) != (ord(surname[0]) < 0x250):
                continue
            surnames.add(surname)
        elif kind == "surname":
            if not _is_name(m[kind]):
                continue
            surnames.add(m[kind])
        out.append(("secret" if kind in ("quoted", "single") else kind, *m.span(kind)))
    if surnames:
        alone = re.compile(rf"(?<![\w-])(?:{'|'.join(sorted(map(re.escape, surnames), key=lambda x: (-len(x), x)))})(?![\w-])")
        more, k = [], 0
        for m in alone.finditer(text):
            i, j = m.span()
            while k < len(out) and out[k][2] <= i:
                k += 1
            if k == len(out) or j <= out[k][1]:
                more.append(("surname", i, j))
        out = sorted(out + more, key=lambda x: x[1])
    return out


_SCHEMA = "array<struct<kind:string,start:int,length:int,surrogate:string>>"


def replace(df: DataFrame, key: bytes, text: str = "text", entities: str = "entities") -> DataFrame:
    """``df`` with surrogates in ``text`` and the column ``entities``: kind, start (in the old text), length, surrogate.

    Texts are worked on in place, in one pass without a shuffle.
    """
    kept = df.drop(entities)
    schema = widened(kept, (entities, _SCHEMA))
    kind_of = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32()), ("surrogate", pa.string())]))

    def run(batches):
        own = Surrogates(key)
        for b in batches:
            texts, found = [], []
            at = b.schema.get_field_index(text)
            for t in b.column(at).to_pylist():
                rows, out, end = [], [], 0
                for kind, i, j in find(t) if t else ():
                    new = own.make(kind, t[i:j])
                    rows.append((kind, i, j - i, new))
                    out += [t[end:i], new]
                    end = j
                texts.append("".join([*out, t[end:]]) if rows else t)
                found.append([dict(zip(("kind", "start", "length", "surrogate"), r, strict=True)) for r in rows])
            cols = list(b.columns)
            cols[at] = pa.array(texts, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*cols, pa.array(found, kind_of)], names=[*b.schema.names, entities])

    return kept.mapInArrow(run, schema)


def mentions(df: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """kind, entity (canonical) and surrogate (canonical) of every mention."""

    def run(batches):
        own = Surrogates(key)
        for b in batches:
            rows = [(k, canonical(k, t[i:j]), canonical(k, own.make(k, t[i:j]))) for t in b.column(0).to_pylist() if t for k, i, j in find(t)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*rows, strict=True) if rows else ([], [], []))], names=["kind", "entity", "surrogate"])

    return df.select(text).mapInArrow(run, "kind string, entity string, surrogate string")


def collisions(df: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """Surrogates that two entities share and entities with two surrogates; empty if all is well.

    The distinct entities meet by surrogate and by entity, summed before the shuffle.
    """
    pairs = mentions(df, key, text).distinct()
    shared = pairs.groupBy("kind", F.col("surrogate").alias("value")).agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("surrogate"))
    split = pairs.groupBy("kind", F.col("entity").alias("value")).agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("entity"))
    return shared.unionByName(split).where("n > 1")


def checked(df: DataFrame, key: bytes, text: str = "text", entities: str = "entities") -> DataFrame:
    """``replace`` with ``n_ambiguous``: how many of a row's surrogates ``collisions`` names.

    The surrogates are distinct by construction, so the check finds nothing; if it does, the rows are marked and none is lost.
    """
    out = replace(df.drop("n_ambiguous"), key, text, entities)
    clashes, path = settle(collisions(df, key, text), "pii-clashes")
    if clashes.isEmpty():
        remove_path(df.sparkSession, path)
        return out.withColumn("n_ambiguous", F.lit(0).cast("long"))
    shared = clashes.where("what = 'surrogate'").select("kind", F.col("value").alias("surrogate")).distinct()
    numbered = settle(out.withColumn("row_", F.monotonically_increasing_id()), "pii-rows")[0]
    named = numbered.select("row_", F.explode(entities).alias("e")).select("row_", "e.kind", _canonical("e.kind", "e.surrogate").alias("surrogate"))
    bad = named.join(shared, ["kind", "surrogate"], "left_semi").groupBy("row_").agg(F.count(F.lit(1)).alias("n_ambiguous"))
    return numbered.join(bad, "row_", "left").withColumn("n_ambiguous", F.coalesce("n_ambiguous", F.lit(0))).drop("row_")


def _canonical(kind: str, value: str):
    """``canonical`` as a column."""
    k, v = F.col(kind), F.col(value)
    return F.when(k.isin("card", "iban", "ssn"), F.regexp_replace(v, "[ -]", "")).when(k == "phone", F.right(F.regexp_replace(v, "[^0-9]", ""), F.lit(10))).when(
        (k == "email") | (k == "secret") & v.rlike("^[0-9a-fA-F]+$"), F.lower(v)).otherwise(v)
