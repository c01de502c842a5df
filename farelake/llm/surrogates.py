"""Personal data and secrets replaced by keyed surrogates of the same type and format.

An entity has the same surrogate wherever it occurs and however it is written:
case, the spacing of numbers, and with or without a given name. Different
entities have different ones, which are no entities of the corpus themselves.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.scratch import written

_TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Mlle", "Señora", "Sra", "Signora", "Госпожа"),
    "m": ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Господин"),
}
_GENDER = {t: g for g, ts in _TITLES.items() for t in ts}
_TITLE = "|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True))

#: Names to draw from, by script and gender; surnames are made of their syllables.
GIVEN = {
    ("LATIN", "f"): ("Anna", "Clara", "Elena", "Greta", "Irene", "Laura", "Marta", "Nora", "Paula", "Sofia"),
    ("LATIN", "m"): ("Adrian", "Bruno", "David", "Felix", "Hugo", "Jonas", "Lukas", "Martin", "Oskar", "Simon"),
    ("CYRILLIC", "f"): ("Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Софья", "Юлия"),
    ("CYRILLIC", "m"): ("Антон", "Борис", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Максим", "Олег", "Роман"),
    ("GREEK", "f"): ("Άννα", "Ελένη", "Ειρήνη", "Ζωή", "Ιωάννα", "Μαρία", "Νίκη", "Σοφία"),
    ("GREEK", "m"): ("Γιώργος", "Ηλίας", "Κώστας", "Λευτέρης", "Μάριος", "Νίκος", "Πέτρος", "Στέφανος"),
}
_SYLLABLES = {
    "LATIN": ("ba", "del", "fin", "gor", "hal", "kem", "lin", "mar", "nov", "rad", "sol", "ter", "ven", "wil"),
    "CYRILLIC": ("ба", "вен", "гор", "дел", "зим", "кам", "лин", "мар", "нов", "рад", "сол", "тер"),
    "GREEK": ("βα", "γορ", "δελ", "καμ", "λιν", "μαρ", "νοβ", "ραδ", "σολ", "τερ"),
}

# A name of one part; hyphens and apostrophes join its pieces.
_NAME = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"

# In this order: where two overlap, the one that begins first stays, then the earlier type.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
PATTERNS = {
    "secret": r"(?i:\b(?:token|password|passwd|secret|api[_-]?key))\s*[=:]\s*\"?(?P<secret>[\w+/.~-]{6,})",
    "access_key": r"\b(?P<access_key>AKIA[0-9A-Z]{16})\b",
    "email": r"(?P<email>[A-Za-z0-9][\w.+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})",
    "ip": rf"(?<![\w.])(?P<ip>{_OCTET}(?:\.{_OCTET}){{3}})(?![\w]|\.\d)",
    "card": r"(?<![\w-])(?P<card>\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7})(?![\w-])",
    "phone": r"(?<![\w+])(?P<phone>\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}-\d{4})(?!\w)",
    "person": rf"\b(?P<title>{_TITLE})\.? (?P<person>{_NAME}(?: {_NAME})?)",
}
_ALL = re.compile("|".join(PATTERNS.values()))
#: Every text with an entity matches this. Words are tried only where one of their first letters is.
_FIRST = "".join(sorted({*"tTpPsSkK", *(title[0] for title in _GENDER)}))
LIKELY = rf"[0-9@]|(?=[{_FIRST}])(?:(?i:token|passw|secret|key)|{_TITLE})"


# First two digits of country calling codes that have three; those with 1 and 7 have one, others two.
_LONG_CODES = {
    "21", "22", "23", "24", "25", "26", "29", "35", "37", "38", "42", "50", "59",
    "67", "68", "69", "80", "85", "87", "88", "96", "97", "99",
}


@dataclass(frozen=True)
class Part:
    """What has a surrogate of its own; ``name`` is the same for all ways to write it."""

    start: int
    end: int
    kind: str
    name: str


@dataclass(frozen=True)
class Entity:
    start: int
    end: int
    kind: str
    text: str
    parts: tuple[Part, ...]


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10


def _script(name: str) -> str:
    found = {unicodedata.name(c, "?").split()[0] for c in name if c.isalpha()}
    return next(iter(found)) if len(found) == 1 else "MIXED"


def _named(kind: str, text: str) -> str:
    """An entity without what differs between ways to write it."""
    if kind in ("phone", "card"):
        return ("+" if text.startswith("+") else "") + "".join(c for c in text if c.isdigit())
    if kind in ("email", "surname") or kind.startswith("given"):
        return unicodedata.normalize("NFC", text).lower().replace("’", "'")
    return text


def _person(start: int, text: str, gender: str) -> Entity | None:
    """A titled name: its words that begin with a capital, of which the last one is the surname."""
    words = [(m.start(), m[0]) for m in re.finditer(r"\S+", text)]
    words = words[: next((i for i, (_, w) in enumerate(words) if not w[0].isupper()), len(words))]
    if not words:
        return None
    parts = tuple(
        Part(start + at, start + at + len(w), kind, _named(kind, w))
        for kind, (at, w) in zip([f"given_{gender}"] * (len(words) - 1) + ["surname"], words, strict=True)
    )
    end = parts[-1].end
    return Entity(start, end, f"person_{gender}", text[: end - start], parts)


def _mentions(text: str, entities: list[Entity]) -> list[Entity]:
    """Later mentions, without a title, of names that a text has introduced with one."""
    kinds: dict[str, tuple[str, str, int]] = {}
    for e in entities:
        if e.kind.startswith("person"):
            for p in e.parts:
                if p.kind == "surname" or len(e.parts) > 1:
                    kinds.setdefault(p.name, (p.kind, e.kind, e.end))
    if not kinds:
        return []
    after = min(end for *_, end in kinds.values())
    names = "|".join(sorted((re.escape(n).replace("'", "['’]") for n in kinds), key=len, reverse=True))
    out = []
    for m in re.finditer(rf"(?<![\w'’-])(?:{names})(?![\w’-])", text[after:], re.IGNORECASE):
        kind, person, end = kinds.get(_named("surname", m[0]), ("", "", len(text)))
        start = after + m.start()
        if kind and m[0][0].isupper() and start >= end:
            part = Part(start, start + len(m[0]), kind, _named(kind, m[0]))
            out.append(Entity(part.start, part.end, person, m[0], (part,)))
    return out


def find_entities(text: str) -> list[Entity]:
    """The entities of a text, in order, none overlapping another."""
    out = []
    for m in _ALL.finditer(text):
        kind = m.lastgroup if m.lastgroup != "title" else "person"
        start, body = m.start(kind), m[kind]
        if kind == "person":
            if (found := _person(start, body, _GENDER[m["title"]])) is not None:
                out.append(found)
            continue
        end = start + len(body)
        out.append(Entity(start, end, kind, body, (Part(start, end, kind, _named(kind, body)),)))
    more = _mentions(text, out)
    if not more:
        return out
    taken, merged = 0, []
    for e in sorted([*out, *more], key=lambda e: (e.start, -e.end)):
        if e.start >= taken:
            merged.append(e)
            taken = e.end
    return merged


def _bytes(key: bytes, *parts: object) -> Iterator[int]:
    """As many keyed pseudorandom bytes as are asked for."""
    message = "\x1f".join(map(str, parts)).encode()
    for block in range(1 << 30):
        yield from hmac.new(key, message + block.to_bytes(4, "big"), hashlib.sha256).digest()


def _made_name(kind: str, name: str, attempt: int, below: Callable[[int], int]) -> str:
    """A name in small letters, of the same script, gender and number of pieces."""
    script = _script(name)
    script = script if script in _SYLLABLES else "LATIN"
    pieces = re.split(r"(['-])", name)
    out = []
    for i, piece in enumerate(pieces):
        syllables = _SYLLABLES[script]
        if i % 2:
            out.append(piece)
        elif len(piece) == 1:
            out.append(syllables[below(len(syllables))][0])
        elif kind.startswith("given") and attempt < 3:
            given = GIVEN[script, kind[-1]]
            out.append(given[below(len(given))].lower())
        else:
            out.append("".join(syllables[below(len(syllables))] for _ in range(3 + attempt // 8)))
    return "".join(out)


def surrogate(key: bytes, kind: str, name: str, attempt: int) -> str:
    """A replacement of the same type and shape; the same for the same arguments.

    ``name`` is what ``Part`` has; ``spelled`` puts the result as a place has it.
    Digits stand for digits, letters for letters of the same case (hexadecimal
    ones if all are), and other characters stay. A card number that passes the
    Luhn test is replaced by one that does, an address by a valid one, a phone
    number keeps its country code, and an e-mail address its top-level domain.
    A name gets one of the same gender and script, with as many pieces.
    """
    draw = _bytes(key, kind, name, attempt)

    def below(n: int) -> int:
        return int.from_bytes(bytes(next(draw) for _ in range(4)), "big") % n

    if kind == "surname" or kind.startswith("given"):
        return _made_name(kind, name, attempt, below)
    if kind == "ip":
        return ".".join(str(1 + below(254)) for _ in range(4))
    keep = 0
    tail = len(name)
    if kind == "phone" and name.startswith("+"):
        keep = 2 if name[1] in "17" else 4 if name[1:3] in _LONG_CODES else 3
    elif kind == "access_key":
        keep = 4
    elif kind == "email":
        tail = name.rindex(".")
    letters = [c for c in name if c.isalpha()]
    hexadecimal = kind == "secret" and all(c in "abcdef" for c in letters)
    out = []
    for i, c in enumerate(name):
        if i < keep or i >= tail:
            out.append(c)
        elif c.isdigit():
            out.append(str(below(10)))
        elif c.isalpha() and hexadecimal:
            out.append("abcdef"[below(6)])
        elif c.isalpha():
            made = chr(ord("a") + below(26))
            out.append(made.upper() if c.isupper() else made)
        else:
            out.append(c)
    if kind == "card":
        out[0] = name[0]  # the first digit names the kind of card
        wanted = _luhn(name) == 0
        for last in "0123456789":
            out[-1] = last
            if (_luhn("".join(out)) == 0) == wanted:
                break
    return "".join(out)


def spelled(kind: str, text: str, made: str) -> str:
    """A surrogate in the way in which a place has written the entity."""
    if kind in ("phone", "card"):
        digits = iter(made.lstrip("+"))
        return "".join(next(digits) if c.isdigit() else c for c in text)
    if kind == "email":
        return "".join(m.upper() if c.isupper() else m for c, m in zip(text, made, strict=True))
    if kind == "surname" or kind.startswith("given"):
        if len(text) > 1 and text.isupper():
            return made.upper()
        return re.sub(r"[^\W\d_]+", lambda m: m[0].capitalize(), made)
    return made


@dataclass(frozen=True)
class Surrogates:
    """``key`` makes the surrogates; whoever has it can find out which entity one stands for.

    ``attempts`` bounds how often an entity whose surrogate is taken tries another.
    """

    key: bytes = field(repr=False)
    attempts: int = 200

    def __post_init__(self) -> None:
        if len(self.key) < 8:
            raise ValueError("a key of fewer than eight bytes keeps nothing secret")


def occurrences(rows: DataFrame) -> DataFrame:
    """``id``, ``kind``, ``entity``: the distinct parts of entities in each text, by their names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, kinds, entities = [], [], []
            for i, body in enumerate(batch.column("text").to_pylist()):
                parts = {(p.kind, p.name) for e in find_entities(body or "") for p in e.parts}
                for kind, entity in sorted(parts):
                    ids.append(i)
                    kinds.append(kind)
                    entities.append(entity)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(ids, pa.int64())), pa.array(kinds, pa.string()),
                 pa.array(entities, pa.string())],
                ["id", "kind", "entity"],
            )

    return rows.select("id", "text").mapInArrow(run, "id string, kind string, entity string")


def assign(entities: DataFrame, how: Surrogates) -> DataFrame:
    """``kind``, ``entity``, ``surrogate`` of distinct entities: one for each, none taken twice.

    Entities that want the same surrogate, or one that is an entity itself, are
    found by an aggregate and two anti joins; the first by text keeps it and the others
    try again. Each round is written.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                surrogate(how.key, kind, entity, attempt)
                for kind, entity, attempt in zip(
                    *(batch.column(c).to_pylist() for c in ("kind", "entity", "attempt")), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("kind", "entity")), pa.array(made, pa.string())],
                ["kind", "entity", "surrogate"],
            )

    taken = None
    known = entities.select(F.col("entity").alias("surrogate")).distinct()
    waiting = entities
    for attempt in range(how.attempts):
        wanted = written(
            waiting.withColumn("attempt", F.lit(attempt)).mapInArrow(
                run, "kind string, entity string, surrogate string"
            ),
            "wanted",
        )
        free = wanted.join(known, "surrogate", "left_anti")
        if taken is not None:
            free = free.join(taken.select("surrogate"), "surrogate", "left_anti")
        got = written(
            free.groupBy("surrogate")
            .agg(F.min(F.struct("entity", "kind")).alias("first"))
            .select("first.kind", "first.entity", "surrogate"),
            "assigned",
        )
        taken = got if taken is None else taken.unionByName(got)
        waiting = written(
            wanted.select("kind", "entity").join(got, ["kind", "entity"], "left_anti"), "waiting"
        )
        if waiting.isEmpty():
            return taken
    raise RuntimeError(f"no free surrogate after {how.attempts} attempts: the formats leave too few")


def replace_entities(
    docs: DataFrame, how: Surrogates, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text``, ``n_entities``, ``kinds``.

    ``text`` has a surrogate for each entity, ``n_entities`` counts the places,
    and ``kinds`` has the number of places of each type. Whole texts are read.
    A person is one place, whose given name and surname have surrogates of their
    own, so that a surname alone is replaced by the same one; later mentions in
    the same text, without a title, are replaced too.
    Only texts that may have an entity are shuffled, to meet the surrogates of
    their own entities; all others pass through. A null text stays null. Rows
    without an id, or that share one, are treated one by one. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    likely = F.coalesce(F.col("text").rlike(LIKELY), F.lit(False))
    # Rows of one text share its surrogates, whatever their ids.
    concerned = rows.where(likely).withColumn("id", F.sha2("text", 256))
    found = written(occurrences(concerned), "entities")
    assigned = assign(found.select("kind", "entity").distinct(), how)
    own = (
        found.distinct()
        .join(assigned, ["kind", "entity"])
        .groupBy("id")
        .agg(F.collect_list(F.struct("kind", "entity", "surrogate")).alias("own"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, kinds = [], [], []
            for body, pairs in zip(
                batch.column("text").to_pylist(), batch.column("own").to_pylist(), strict=True
            ):
                by = {(p["kind"], p["entity"]): p["surrogate"] for p in pairs or []}
                out, at, n = [], 0, {}
                for e in find_entities(body) if by else []:
                    for p in e.parts:
                        made = spelled(p.kind, body[p.start : p.end], by[p.kind, p.name])
                        out += [body[at : p.start], made]
                        at = p.end
                    n[e.kind] = n.get(e.kind, 0) + 1
                texts.append("".join([*out, body[at:]]))
                counts.append(sum(n.values()))
                kinds.append(sorted(n.items()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(texts, pa.string()),
                    pa.array(counts, pa.int64()),
                    pa.array(kinds, pa.map_(pa.string(), pa.int64())),
                ],
                ["doc_id", "text", "n_entities", "kinds"],
            )

    replaced = (
        concerned.join(own, "id", "left")
        .select("doc_id", "text", "own")
        .mapInArrow(run, f"doc_id {kind}, text string, n_entities bigint, kinds map<string,bigint>")
    )
    plain = rows.where(~likely).select(
        "doc_id",
        "text",
        F.lit(0).cast("bigint").alias("n_entities"),
        F.expr("cast(map() as map<string,bigint>)").alias("kinds"),
    )
    return replaced.unionByName(plain)
