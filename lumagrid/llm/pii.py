"""Personal data replaced by surrogates: keyed, of the same type and form, distinct, the same everywhere.

Found are e-mail addresses, phone numbers, IPv4 addresses, payment cards (valid check digit), IBANs (valid
check number), social security numbers, credentials, and names after a form of address. A mention is cut into
entities: a name into given names and surname, so "Ms Anna Stone" and "Ms Stone" share a surrogate surname.
The parts of a name are looked for again in the whole document, so a lone "Anna" or "Stone" gets them too. The
gender of a name is that of any titled mention: "Dr Anna Stone" follows "Ms Anna Stone"; a name with titles of
both genders keeps them apart.

A surrogate is drawn with HMAC(key, kind, entity, attempt) and has the entity's form: digits for digits of the
same script, letters for letters, the same separators, valid check digits, given names of the same gender and
script. Collision checks keep distinct entities distinct: among entities of a kind (for names: of a script, whatever
the gender) that draw the same surrogate, one keeps it, the others, and any whose surrogate occurs in the corpus
itself, draw again, until all differ.
This runs over the table of distinct entities, by shuffles. Documents with mentions then meet their
surrogates in a join; documents without mentions pass by.

Edge cases: null stays null and an empty text empty; repeated rows are rewritten alike; an empty table gives an
empty result; columns other than the text are kept, and inner columns take names that are not in use; what has the form and
length of a country's IBAN but a wrong check number is left whole, and nothing is looked for inside it.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumagrid.llm.common import apart, free, materialise, ready

# Forms of address with the gender they tell, and names to draw from.
TITLES = {
    "m": ["Mr", "Mister", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "господин", "г-н"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Srta", "госпожа", "г-жа"],
    "n": ["Mx", "Dr", "Prof"],
}
GIVEN = {
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leo"],
    ("latin", "f"): ["Alma", "Berta", "Clara", "Dora", "Elsa", "Flora", "Greta", "Helen", "Ida", "Julia", "Klara", "Lena"],
    ("latin", "n"): ["Alex", "Ariel", "Casey", "Dana", "Eden", "Jamie", "Kim", "Lee", "Morgan", "Robin", "Sam", "Toni"],
    ("cyrillic", "m"): ["Андрей", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Леонид", "Максим"],
    ("cyrillic", "f"): ["Алла", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина", "Клара", "Лидия"],
    ("cyrillic", "n"): ["Саша", "Женя", "Валя", "Шура"],
}
SYLLABLES = {
    "latin": ["bar", "den", "fol", "gan", "har", "kes", "lam", "mor", "nel", "pol", "ros", "sten", "tor", "ven", "wal", "zim"],
    "cyrillic": ["бар", "ден", "вол", "гон", "кар", "лес", "мор", "нел", "пол", "рос", "стен", "тор"],
}
ENDINGS = {
    ("latin", "m"): ["er", "man", "son"], ("latin", "f"): ["er", "man", "son"], ("latin", "n"): ["er", "man", "son"],
    ("cyrillic", "m"): ["ов", "ин"], ("cyrillic", "f"): ["ова", "ина"], ("cyrillic", "n"): ["енко", "ко"],
}

# Characters of an IBAN by country.
IBAN_LENGTH = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}

_GENDER = {form: gender for gender, titles in TITLES.items() for title in titles for form in (title, title.upper())}
_TITLE = "|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True))
_GENDERED = "^((?:given|surname):[a-z]+):[mfn]$"
_WORDS = ("password", "passwd", "token", "secret", "api_key", "apikey")
_NAME = r"(?:[^\W\d_a-zа-яß-öø-ÿ][^\W\d_]+(?:[-'’][^\W\d_]+)*)"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERN = re.compile(
    r"(?P<email>[\w.%+\-]{1,64}@[\w\-]{1,63}(?:\.[\w\-]{1,63}){0,8}\.[^\W\d_]{2,24})"
    rf"|(?P<ip>(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\w]|\.\d))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}(?!\w)"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)|(?<![\w.-])\d{3}[-.]\d{3}[-.]\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-]))"
    r"|(?P<access>(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w))"
    r"|(?:(?<!\w)(?i:password|passwd|token|secret|api_?key)[ \t]*[=:][ \t]*[\"']?(?P<secret>[^\s\"']{8,})[\"']?)"
    rf"|(?:(?<!\w)(?P<title>{_TITLE})\.?[  ](?P<name>{_NAME}(?: {_NAME}){{0,2}}))"
)
_WORD = re.compile(r"(?<!\w)[^\W\d_]+(?!\w)(?:[-'’][^\W\d_]+(?!\w))*")
_DIGIT_OR_AT = re.compile(r"[\d@]")


def hinted(text: str) -> bool:
    """False only if a text has no mention; far quicker than the pattern."""
    if _DIGIT_OR_AT.search(text) or "AKIA" in text or "ASIA" in text or any(title in text for title in _GENDER):
        return True
    lower = text.lower()
    return any(word in lower for word in _WORDS)


MENTIONS = "array<struct<kind: string, entity: string, start: int, stop: int>>"
_MENTION = pa.list_(
    pa.struct([("kind", pa.string()), ("entity", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])
)


def luhn(digits: str) -> bool:
    own = [int(c) for c in digits][::-1]
    return (sum(own[::2]) + sum(sum(divmod(2 * d, 10)) for d in own[1::2])) % 10 == 0


def iban_check(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def card_in(value: str) -> int:
    """Length of the longest card number that ``value`` starts with, cut only at separators; 0 if none."""
    for stop in [len(value), *(i for i in range(len(value) - 1, 0, -1) if value[i] in " -")]:
        digits = re.sub(r"\D", "", value[:stop])
        if len(digits) < 13:
            break
        if luhn(digits) and len(set(digits)) > 1:
            return stop
    return 0


def iban_in(value: str) -> int:
    """Length of the IBAN that ``value`` starts with, cut only at spaces, where known to the country's length; 0 if none."""
    known = IBAN_LENGTH.get(value[:2])
    for stop in [len(value), *(i for i in range(len(value) - 1, 0, -1) if value[i] == " ")]:
        own = value[:stop].replace(" ", "")
        if stop < len(value) and (len(own) != known if known else len(own) < 15):
            continue
        if iban_check(own) == 1:
            return stop
    return 0


def wrong_iban_in(value: str) -> int:
    """Length of a number of a country's length that ``value`` starts with, its check number being wrong; 0 if none."""
    known = IBAN_LENGTH.get(value[:2])
    for stop in [len(value), *(i for i in range(len(value) - 1, 0, -1) if value[i] == " ")]:
        if len(value[:stop].replace(" ", "")) == known:
            return stop
    return 0


def script_of(word: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in word) else "latin"


def mentions(text: str) -> list[dict]:
    """Entities of a text in order: kind, canonical entity, where it starts and stops."""
    if not text or not hinted(text):
        return []
    found = []
    after = 0
    while m := PATTERN.search(text, after):
        kind, after = m.lastgroup, m.end()
        if kind == "title" or kind == "name":
            gender, at = _GENDER[m["title"]], m.start("name")
            parts = m["name"].split(" ")
            for i, part in enumerate(parts):
                role = "surname" if i + 1 == len(parts) else "given"
                kind = f"{role}:{script_of(part)}:{gender if role == 'given' or script_of(part) == 'cyrillic' else 'n'}"
                found.append({"kind": kind, "entity": part.casefold(), "start": at, "stop": at + len(part)})
                at += len(part) + 1
            continue
        value, start, stop = m[kind], m.start(kind), m.end(kind)
        if kind in ("card", "iban"):
            # What follows a number may look like more of it; what is none may hold one further on.
            size = card_in(value) if kind == "card" else iban_in(value)
            stop = start + size
            after = stop if size else start + max(1, wrong_iban_in(value) if kind == "iban" else 1)
            if not size:
                continue
            entity = re.sub(r"\D", "", value[:size]) if kind == "card" else value[:size].replace(" ", "")
        elif kind == "email":
            entity = value.lower()
        elif kind in ("phone", "ssn"):
            entity = re.sub(r"[^\d+]", "", value)
        else:
            entity = value
        found.append({"kind": kind, "entity": entity, "start": start, "stop": stop})
    return _with_repeats(text, found)


def _with_repeats(text: str, found: list[dict]) -> list[dict]:
    """``found``, gender settled within the text, and every other place where a part of a found name stands."""
    names = [m for m in found if m["kind"].startswith(("given:", "surname:"))]
    if not names:
        return found
    kinds = {}
    for m in names:
        kinds.setdefault((m["kind"][:-1], m["entity"]), set()).add(m["kind"][-1])
    known = {}
    for m in names:
        base = m["kind"][:-1]
        told = kinds[base, m["entity"]] - {"n"}
        if m["kind"][-1] == "n" and len(told) == 1:
            m["kind"] = base + min(told)
        known.setdefault(m["entity"], m["kind"])
    more, at = [], 0
    for word in _WORD.finditer(text):
        pieces = [(word[0], word.start())]
        if word[0].casefold() not in known:
            pieces = [(x[0], word.start() + x.start()) for x in re.finditer(r"[^\W\d_]+", word[0])]
        for shown, start in pieces:
            if (kind := known.get(shown.casefold())) is None or shown[0].islower():
                continue
            stop = start + len(shown)
            while at < len(found) and found[at]["stop"] <= start:
                at += 1
            if at == len(found) or found[at]["start"] >= stop:
                more.append({"kind": kind, "entity": shown.casefold(), "start": start, "stop": stop})
    return sorted(found + more, key=lambda m: m["start"])


class _Draw:
    """A stream of numbers from HMAC(key, kind, entity, attempt)."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int):
        seed = f"{kind}\0{entity}\0{attempt}".encode("utf-8", "surrogatepass")
        self._state, self._at, self._key = hmac.new(key, seed, hashlib.sha256).digest(), 0, key

    def below(self, n: int) -> int:
        if self._at + 4 > len(self._state):
            self._state, self._at = hmac.new(self._key, self._state, hashlib.sha256).digest(), 0
        self._at += 4
        return int.from_bytes(self._state[self._at - 4 : self._at], "big") % n

    def like(self, c: str) -> str:
        """A character of the same class: digits of the same script, letters of the same case."""
        if c.isdecimal():
            return chr(ord(c) - int(c) + self.below(10))
        if "a" <= c <= "z":
            return chr(97 + self.below(26))
        if "A" <= c <= "Z":
            return chr(65 + self.below(26))
        if "а" <= c <= "я":
            return chr(0x430 + self.below(32))
        if "А" <= c <= "Я":
            return chr(0x410 + self.below(32))
        return chr(97 + self.below(26)) if c.isalpha() else c


def surrogate(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """The canonical surrogate of an entity; later attempts widen the room where the form's is small."""
    draw = _Draw(key, kind, entity, attempt)
    if kind == "email":
        local, _, host = entity.rpartition("@")
        labels = ["".join(map(draw.like, x)) for x in host.split(".")[:-1]]
        grown = "".join(chr(97 + draw.below(26)) for _ in range(attempt // 4))
        return f"{''.join(map(draw.like, local))}{grown}@{'.'.join(labels)}.example"
    if kind == "ip":
        octets = [(1, 9), (10, 99), (100, 223)]
        spans = [octets[len(x) - 1] if attempt < 6 else (1, 223) for x in entity.split(".")]
        return ".".join(str(a + draw.below(b - a + 1)) for a, b in spans)
    if kind == "card":
        body = entity[0] + "".join(str(draw.below(10)) for _ in entity[1:-1])
        return body + next(d for d in "0123456789" if luhn(body + d))
    if kind == "iban":
        body = entity[:2] + "00" + "".join(map(draw.like, entity[4:]))
        return f"{body[:2]}{98 - iban_check(body):02d}{body[4:]}"
    if kind == "phone":
        kept = 2 if entity[0] == "+" else 0
        return entity[:kept] + "".join(map(draw.like, entity[kept:]))
    if kind == "access":
        letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
        return entity[:4] + "".join(letters[draw.below(32)] for _ in entity[4:])
    if kind == "secret" and re.fullmatch("[0-9a-f]+", entity):
        return "".join("0123456789abcdef"[draw.below(16)] for _ in entity)
    if kind.startswith("given:"):
        _, script, gender = kind.split(":")
        pool = GIVEN[script, gender]
        tail = SYLLABLES[script][draw.below(len(SYLLABLES[script]))] if attempt > 2 else ""
        more = "".join(SYLLABLES[script][draw.below(len(SYLLABLES[script]))] for _ in range(attempt // 6))
        first = pool[draw.below(len(pool))].lower()
        return first + ("-" + tail + more if tail else "")
    if kind.startswith("surname:"):
        _, script, gender = kind.split(":")
        parts = [SYLLABLES[script][draw.below(len(SYLLABLES[script]))] for _ in range(2 + attempt // 3)]
        return "".join(parts) + ENDINGS[script, gender][draw.below(len(ENDINGS[script, gender]))]
    return "".join(map(draw.like, entity))


def dressed(kind: str, shown: str, value: str) -> str:
    """A canonical surrogate in the form in which the entity was written."""
    if kind.startswith(("given:", "surname:")):
        if shown.isupper() and len(shown) > 1:
            return value.upper()
        return "-".join(p[:1].upper() + p[1:] for p in value.split("-"))
    if kind in ("phone", "ssn", "card"):
        left = iter(value.lstrip("+"))
        return "".join(next(left) if c.isdecimal() else c for c in shown)
    if kind == "iban":
        left = iter(value)
        return "".join(c if c == " " else next(left) for c in shown)
    if kind == "email" and shown.isupper():
        return value.upper()
    return value


def _surrogate_column(key: bytes):
    @F.arrow_udf("string")
    def drawn(kinds: pa.Array, entities: pa.Array, attempts: pa.Array) -> pa.Array:
        rows = zip(kinds.to_pylist(), entities.to_pylist(), attempts.to_pylist())
        return pa.array([surrogate(key, k, e, a) for k, e, a in rows], pa.string())

    return drawn


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, surrogate) for distinct (kind, entity): no two alike in a kind, none an entity itself.

    Given names of a script count as one kind here, and so do surnames.

    A form with less room than it has entities (single digits, say) cannot be told apart by its form alone; after
    64 attempts such an entity gets a number appended.
    """
    drawn = _surrogate_column(key)
    entities = materialise(entities.select("kind", "entity").distinct(), "entities")
    among = F.regexp_replace("kind", _GENDERED, "$1").alias("among")
    taken = entities.select(among, F.col("entity").alias("surrogate"))
    open_, done = entities.withColumn("attempt", F.lit(0)), None
    for attempt in range(65):
        tried = open_.withColumn("surrogate", drawn("kind", "entity", "attempt"))
        if attempt == 64:
            tried = tried.withColumn("surrogate", F.concat("surrogate", F.lit("-"), F.hex(F.xxhash64("kind", "entity"))))
        tried = materialise(tried, "tried")
        first = tried.groupBy(among, "surrogate").agg(F.min(F.struct("entity", "kind")).alias("e"))
        kept = first.join(taken, ["among", "surrogate"], "left_anti") if attempt < 64 else first
        kept = materialise(kept.select("e.kind", "e.entity", "surrogate"), "assigned")
        done = kept if done is None else done.union(kept)
        taken = taken.union(kept.select(among, "surrogate"))
        open_ = tried.join(kept, ["kind", "entity"], "left_anti")
        open_ = materialise(open_.select("kind", "entity", (F.col("attempt") + 1).alias("attempt")), "collided")
        if open_.isEmpty():
            break
    return done


def resolved(entities: DataFrame) -> DataFrame:
    """(kind, entity, as_kind) for distinct (kind, entity): names without a gender take the one they have elsewhere."""
    entities = materialise(entities.select("kind", "entity").distinct(), "kinds")
    base = F.regexp_extract("kind", _GENDERED, 1)
    told = entities.filter(F.col("kind").rlike("^(given|surname):.*:[mf]$")).groupBy(base.alias("base"), "entity")
    told = told.agg(F.min("kind").alias("told"), F.max("kind").alias("last")).filter("told = last").drop("last")
    bare = F.when(F.col("kind").rlike("^(given|surname):.*:n$"), base)
    found = entities.withColumn("base", bare).join(told, ["base", "entity"], "left")
    return found.select("kind", "entity", F.coalesce("told", "kind").alias("as_kind"))


def _find_all(texts: pa.Array) -> pa.Array:
    return pa.array([mentions(t) for t in texts.to_pylist()], _MENTION)


def _replace_all(texts: pa.Array, found: pa.Array) -> pa.Array:
    out = []
    for text, own in zip(texts.to_pylist(), found.to_pylist()):
        parts, at = [], 0
        for m in sorted(own or [], key=lambda m: m["start"]):
            parts += [text[at : m["start"]], dressed(m["kind"], text[m["start"] : m["stop"]], m["surrogate"])]
            at = m["stop"]
        out.append(text if not parts else "".join(parts) + text[at:])
    return pa.array(out, pa.string())


def replace(docs: DataFrame, key: bytes, text: str = "text", counted: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text``; with ``counted``, a column that tells how many entities a text had."""
    ready(docs.sparkSession)
    find, rewrite = F.arrow_udf(_find_all, MENTIONS), F.arrow_udf(_replace_all, "string")
    columns = docs.columns
    found_in, row, chosen_in = free(docs, "_pii_found", "_pii_row", "_pii_chosen")
    # Written with all texts, so that each is searched once.
    found = docs.withColumn(found_in, find(F.col(text))).withColumn(row, F.monotonically_increasing_id())
    found = materialise(found, "mentions")
    plain, hits = found.filter(F.size(found_in) == 0), found.filter(F.size(found_in) > 0)
    single = hits.select(row, F.explode(found_in).alias("m")).select(row, "m.*")
    kinds = materialise(resolved(single), "resolved")
    chosen = assign(kinds.select(F.col("as_kind").alias("kind"), "entity"), key)
    chosen = kinds.join(chosen.withColumnRenamed("kind", "as_kind"), ["as_kind", "entity"]).drop("as_kind")
    single = apart(single).join(chosen, ["kind", "entity"])
    single = single.groupBy(row).agg(
        F.collect_list(F.struct("kind", "start", "stop", "surrogate")).alias(chosen_in)
    )
    rewritten = hits.join(single, row).withColumn(text, rewrite(F.col(text), F.col(chosen_in)))
    number = [] if counted is None else [F.size(found_in).cast("bigint").alias(counted)]
    kept = [f"`{c}`" for c in columns if c != counted]
    return rewritten.select(*kept, *number).union(plain.select(*kept, *number))
