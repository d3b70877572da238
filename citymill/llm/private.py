"""Personal data replaced by keyed surrogates of the same type, format, script and gender.

Every surrogate is a keyed permutation of the entity's canonical form (digits of a number,
lower-cased address, ...) within the strings of the same shape, rendered back into the layout
that the text had. A permutation never maps two entities to one surrogate, so distinctness and
coreference hold over the whole corpus without any shared table. Person names have no such
finite shape: given names move within the list of their gender and script, other names get a
name built from a keyed hash, and a collision check over all distinct names of the corpus
finds those that two names share; the later ones get a further attempt.

Null text stays null and empty text stays empty. Very long texts are read whole. Repeated rows
are replaced alike, overlapping findings go to the one that starts first and then to the
longer one, null ids stay, extra columns are kept (a column named like an output is replaced),
and an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

KEY = "example key; give your own"
EXCEPTIONS = 100_000  # names that need a further attempt; beyond that, longer names are built

# Given names by (script, gender), titles by gender, syllables of built names.
GIVEN = {
    ("latin", "f"): "Anna Maria Emma Julia Laura Sophie Claire Marie Lucia Elena Carmen Isabel Petra Sabine Ingrid Alice Sarah Emily Grace Helen".split(),
    ("latin", "m"): "John James Peter Paul Thomas Martin Lukas Felix Jean Pierre Louis Michel Carlos Miguel Pedro Javier David Robert Henry Simon".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Ирина Наталья Татьяна Светлана".split(),
    ("cyrillic", "m"): "Иван Пётр Алексей Дмитрий Сергей Андрей Николай Михаил".split(),
    ("greek", "f"): "Μαρία Ελένη Άννα Σοφία Κατερίνα Ειρήνη".split(),
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης Πέτρος".split(),
}
TITLES = {"f": "Mrs Ms Miss Frau Madame Mme Señora Sra Doña Госпожа Κυρία".split(), "m": "Mr Sir Herr Monsieur Señor Sr Don Господин Κύριος".split(), "": "Dr Prof Doctor Professor".split()}
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe fi ga ge go ka ke ki ko la le li lo ma me mi mo na ne ni no".split(),
    "cyrillic": "ба бе ва ве да де за ка ко ла ле ли ло ма ме ми мо на не но па по ра ре ро са се со та те то".split(),
    "greek": "βα βε γα γε δα δε ζα θα κα κε κο λα λε λο μα με μο να νε νο πα πε πο ρα ρε ρο σα σε σο τα τε το".split(),
}

_NAME = r"[^\W\d_]['’\-\w]*"
_TITLES = "|".join(sorted((t for all_ in TITLES.values() for t in all_), key=len, reverse=True))
_GIVEN = "|".join(sorted((n for all_ in GIVEN.values() for n in all_), key=len, reverse=True))
PERSON = re.compile(rf"\b(?:(?P<title>{_TITLES})\.? +(?P<titled>{_NAME}(?: {_NAME}){{0,2}})|(?P<given>{_GIVEN}) (?P<family>{_NAME}))")
EMAIL = re.compile(r"(?<![\w.+\-])[A-Za-z0-9_%+\-][A-Za-z0-9._%+\-]*@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}")
SECRET = re.compile(r"""(?i)\b(?:token|secret|password|passwd|api[_\- ]?key|access[_\- ]?key|private[_\- ]?key)\b["']?\s*[=:]\s*["']?([A-Za-z0-9+/_\-.~]{8,})""")
HEX = re.compile(r"(?<![A-Za-z0-9])(?=[0-9A-Fa-f]*[0-9])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![A-Za-z0-9])")
_BYTE = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IP = re.compile(rf"(?<![\w.])(?:{_BYTE}\.){{3}}{_BYTE}(?!\.?\w)")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])")
_GAP = r"[\s.\-*#%&$!]{0,6}"
PHONE = re.compile(rf"(?<![\w+])(?:\+\d{{1,3}}{_GAP}(?:\(\d{{1,4}}\)|\d{{1,4}})(?:{_GAP}\d{{2,4}}){{2,4}}|\(\d{{3}}\){_GAP}\d{{3}}[\s.\-]\d{{4}}|\d{{3}}[.\-]\d{{3}}[.\-]\d{{4}})(?!\w|-\d)")
CARD = re.compile(r"(?<![\w.,\-])\d(?:[ \-]?\d){12,18}(?![\w\-]|[.,]\d)")


def permute(value: int, domain: int, key: str) -> int:
    """A keyed permutation of 0 .. domain - 1: eight Feistel rounds, repeated until the result is inside."""
    if domain < 2:
        return value
    half = max(1, -(-(domain - 1).bit_length() // 2))
    mask, size = (1 << half) - 1, -(-half // 8)
    rounds = _rounds(key)
    while True:
        left, right = value >> half, value & mask
        for seed in rounds:
            digest = b""
            block = right.to_bytes(size, "big")
            for part in range(-(-size // 64)):
                digest += hashlib.blake2b(block + bytes([part & 255]), key=seed, digest_size=min(64, size - 64 * part)).digest()
            left, right = right, left ^ int.from_bytes(digest, "big") & mask
        value = left << half | right
        if value < domain:
            return value


@functools.lru_cache(maxsize=4096)
def _rounds(key: str) -> list[bytes]:
    return [hashlib.blake2b(f"{key}\0{k}".encode(), digest_size=32).digest() for k in range(8)]


_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_HEX = ("0123456789abcdef", "0123456789ABCDEF")


def shuffle_text(text: str, key: str, alphabets: tuple[str, ...] = _CLASSES) -> str:
    """A permutation of the strings of the same shape: each character keeps its alphabet, others stay."""
    value, domain, places = 0, 1, []
    for c in text:
        own = next((a for a in alphabets if c in a), None)
        places.append(own)
        if own:
            value, domain = value * len(own) + own.index(c), domain * len(own)
    shape = "".join(str(alphabets.index(a)) if a else f"[{c}]" for a, c in zip(places, text, strict=True))
    value, out = permute(value, domain, f"{key}\0{shape}"), []
    for c, own in zip(reversed(text), reversed(places), strict=True):
        if own:
            value, at = divmod(value, len(own))
            c = own[at]
        out.append(c)
    return "".join(reversed(out))


def _walk(start: str, step: Callable[[str], str], allowed: Callable[[str], bool]) -> str:
    """Steps until the result is allowed; a permutation of what is allowed, as start is."""
    value = step(start)
    while not allowed(value):
        value = step(value)
    return value


def _luhn(digits: str) -> bool:
    return sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10 == 0


def _digits_into(layout: str, digits: str) -> str:
    left = iter(digits)
    return "".join(next(left) if "0" <= c <= "9" else c for c in layout)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _case_of(pattern: str, text: str) -> str:
    return "".join(c.upper() if p.isupper() else c for p, c in zip(pattern, text, strict=True))


def email(found: str, key: str) -> str:
    local, _, host = found.lower().rpartition("@")
    *labels, top = host.split(".")
    step = lambda x: shuffle_text(x, f"{key}\0label")
    labels = [x if x in ("example", "www") else _walk(x, step, lambda y: y not in ("example", "www")) for x in labels]
    return _case_of(found, f"{shuffle_text(local, f'{key}{chr(0)}local')}@{'.'.join([*labels, top])}")


def phone(found: str, key: str) -> str:
    digits = _only_digits(found)
    plus = re.match(r"\+(\d{1,3})(?=\D)", found)
    country = plus[1] if plus else "1" if len(digits) == 11 and digits[0] == "1" else ""
    rest = digits[len(country) :]
    fictional = lambda x: len(x) == 10 and x[3:6] == "555"
    if fictional(rest):  # the exchange for invented numbers stays
        moved = shuffle_text(rest[:3] + rest[6:], f"{key}\0fictional")
        rest = moved[:3] + "555" + moved[3:]
    else:
        rest = _walk(rest, lambda x: shuffle_text(x, f"{key}\0phone"), lambda x: not fictional(x))
    return _digits_into(found, country + rest)


def card(found: str, key: str) -> str:
    digits = _only_digits(found)
    if _luhn(digits):
        body = shuffle_text(digits[:-1], f"{key}\0card")
        return _digits_into(found, next(body + str(d) for d in range(10) if _luhn(body + str(d))))
    return _digits_into(found, _walk(digits, lambda x: shuffle_text(x, f"{key}\0number"), lambda x: not _luhn(x)))


def ip(found: str, key: str) -> str:
    """The network part of private addresses stays; other addresses stay outside of them."""
    value = int.from_bytes(bytes(map(int, found.split("."))), "big")
    private = ((10 << 24, 24), (172 << 24 | 16 << 16, 20), (192 << 24 | 168 << 16, 16), (127 << 24, 24))
    base, bits = next(((b, n) for b, n in private if value >> n == b >> n), (0, 32))
    while True:
        value = base | permute(value & ((1 << bits) - 1), 1 << bits, f"{key}\0ip{base}")
        if bits < 32 or not any(value >> n == b >> n for b, n in private):
            return ".".join(map(str, value.to_bytes(4, "big")))


def ssn(found: str, key: str) -> str:
    return _digits_into(found, shuffle_text(_only_digits(found), f"{key}\0ssn"))


def iban(found: str, key: str) -> str:
    plain = found.replace(" ", "")
    body = shuffle_text(plain[4:], f"{key}\0iban{plain[:2]}")
    check = 98 - int("".join(str(int(c, 36)) for c in body + plain[:2] + "00")) % 97
    left = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(left) for c in found)


def secret(found: str, key: str) -> str:
    alphabet = next((a for a in _HEX if all(c in a for c in found)), None) if len(found) >= 32 else None
    return shuffle_text(found, f"{key}\0secret", (alphabet,) if alphabet else _CLASSES)


KINDS: dict[str, Callable[[str, str], str]] = {"email": email, "secret": secret, "iban": iban, "ip": ip, "ssn": ssn, "phone": phone, "card": card}


def script_of(text: str) -> str:
    name = next((unicodedata.name(c, "") for c in text if c.isalpha()), "")
    return next((s for s in SYLLABLES if name.startswith(s.upper())), "latin")


@functools.lru_cache(maxsize=100_000)
def name_word(word: str, gender: str, key: str, attempt: int, width: int) -> str:
    """Another name of the same script, and of the same gender if it is a known given name."""
    lower = unicodedata.normalize("NFC", word).lower()
    for (script, sex), names in GIVEN.items():
        known = [n.lower() for n in names]
        if lower in known and attempt == 0:
            return _as_case(word, names[permute(known.index(lower), len(names), f"{key}\0given{script}{sex}")])
    pool = SYLLABLES[script_of(word)]
    digest = int.from_bytes(hashlib.blake2b(f"{lower}\0{attempt}".encode(), key=_rounds(key)[0], digest_size=16).digest(), "big")
    out = []
    for _ in range(width):
        digest, at = divmod(digest, len(pool))
        out.append(pool[at])
    return _as_case(word, "".join(out).capitalize())


def _as_case(word: str, name: str) -> str:
    return name.upper() if word.isupper() and len(word) > 1 else name.lower() if word.islower() else name


def findings(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), in order and apart from each other; kind person:<gender> for names."""
    out = []
    if "@" in text:
        out += [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    if re.search(r"\d", text):
        for kind, pattern in (("secret", HEX), ("iban", IBAN), ("ip", IP), ("ssn", SSN), ("phone", PHONE), ("card", CARD)):
            out += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
        # a number that fits several kinds has the first kind of this order
        order = {kind: k for k, kind in enumerate(KINDS)}
        out.sort(key=lambda x: (x[0], -x[1], order[x[2]]))
    out += [(m.start(1), m.end(1), "secret") for m in SECRET.finditer(text)] if "=" in text or ":" in text else []
    for m in PERSON.finditer(text):
        start, end = m.span("titled" if m["title"] else "given")
        words = []
        for w in re.finditer(_NAME, text[start : m.end()]):
            if not w[0][0].isupper():
                break
            words.append(w)
        if m["title"] and words or len(words) == 2:
            end = start + words[-1].end()
            gender = next((g for g, all_ in TITLES.items() if m["title"] in all_), "") if m["title"] else next(s for (_, s), names in GIVEN.items() if m["given"] in names)
            out.append((start, end, f"person:{gender}"))
    out.sort(key=lambda x: (x[0], -x[1]))
    apart, last = [], 0
    for x in out:
        if x[0] >= last:
            apart.append(x)
            last = x[1]
    return apart


def person(found: str, gender: str, key: str, attempts: dict[str, int], width: int) -> str:
    attempt = attempts.get(canonical_name(found), 0)
    return re.sub(_NAME, lambda m: name_word(m[0], gender, key, attempt, width), found)


def canonical_name(found: str) -> str:
    return " ".join(unicodedata.normalize("NFC", found).lower().split())


def replace(text: str, key: str, attempts: dict[str, int], width: int) -> tuple[str, list[dict]]:
    """The text with surrogates, and (kind, start, end, surrogate) by place in the new text."""
    out, found, at, shift = [], [], 0, 0
    for start, end, kind in findings(text):
        own = text[start:end]
        new = person(own, kind[7:], key, attempts, width) if kind.startswith("person") else KINDS[kind](own, key)
        out += [text[at:start], new]
        found.append({"kind": kind.partition(":")[0], "start": start + shift, "end": start + shift + len(new), "surrogate": new})
        at, shift = end, shift + len(new) - (end - start)
    return "".join([*out, text[at:]]), found


def _names(docs: DataFrame, key: str) -> DataFrame:
    """name: each canonical person name of the corpus once."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found = {canonical_name(t[a:b]) for t in common.texts_of(batch, "text") if PERSON.search(t) for a, b, kind in findings(t) if kind.startswith("person")}
        return pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["name"]) if found else None

    return common.map_batches(docs.select("text"), work, "name string").distinct()


def name_attempts(docs: DataFrame, key: str = KEY, exceptions: int = EXCEPTIONS, width: int = 5) -> tuple[dict[str, int], int]:
    """Attempts for the names whose surrogates would collide, and the syllables of a built name.

    Names get longer where more than `exceptions` collide or eight rounds leave collisions.
    """
    names, attempts, rounds = _names(docs, key).checkpoint(), {}, 0
    while True:
        given, rounds = dict(attempts), rounds + 1

        def work(batch: pa.RecordBatch, given: dict = given, width: int = width) -> pa.RecordBatch:
            own = batch.column("name").to_pylist()
            return pa.RecordBatch.from_arrays([batch.column("name"), pa.array([canonical_name(person(n, "", key, given, width)) for n in own], pa.string())], ["name", "surrogate"])

        ranked = common.map_batches(names, work, "name string, surrogate string").withColumn("rank", F.row_number().over(Window.partitionBy("surrogate").orderBy("name")))
        again = ranked.where(F.col("rank") > 1).select("name").limit(exceptions + 1).collect()  # at most exceptions + 1 names
        if not again:
            return attempts, width
        if len(again) > exceptions or rounds > 8:
            width, attempts, rounds = width + 1, {}, 0
            continue
        for r in again:
            attempts[r.name] = attempts.get(r.name, 0) + 1


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """docs with surrogates in text, and entities (kind, start, end, surrogate) by place in the new text."""
    attempts, width = name_attempts(docs, key)
    shared = docs.sparkSession.sparkContext.broadcast(attempts)  # at most EXCEPTIONS names
    columns = [c for c in docs.columns if c != "entities"]
    docs = docs.select(*columns)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("surrogate", pa.string())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, entities = [], []
        for text in batch.column("text").to_pylist():
            new, found = (None, []) if text is None else replace(text, key, shared.value, width)
            texts.append(new)
            entities.append(found)
        arrays = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in columns]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(entities, kind)], [*columns, "entities"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return common.map_batches(docs, work, f"{schema}, entities array<struct<kind:string,start:int,end:int,surrogate:string>>")


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pseudonymise(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), "entities")
