"""Personal data replaced by keyed surrogates of the same kind."""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripguard.llm.common import discard, slices, table, texts_of, written
from tripguard.session import ensure_checkpoint_dir

# Entities of which the retries are broadcast; beyond it they are joined by text.
BROADCAST_RETRIES = 100_000
# A person of whom neither title nor given name nor another text tells the gender.
DEFAULT_PERSON = "person-m"

# Given names by script and gender, and titles that tell a gender.
GIVEN_NAMES = {
    ("latin", "f"): "Anna Maria Emma Laura Julia Sofia Clara Elena Alice Sarah Carmen Louise Ingrid Martha Nora Irene".split(),
    ("latin", "m"): "John Peter Paul Thomas Martin David Lucas Daniel Robert Michael Carlos Pierre Hans Victor Simon Oscar".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Ирина Наталья Татьяна Светлана Юлия Вера Нина Галина".split(),
    ("cyrillic", "m"): "Иван Пётр Павел Алексей Сергей Дмитрий Андрей Михаил Николай Виктор Олег Борис".split(),
    ("greek", "f"): "Μαρία Ελένη Αικατερίνη Σοφία Άννα Ειρήνη Βασιλική Δήμητρα".split(),
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης Παύλος Πέτρος Ανδρέας".split(),
}
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Herrn": "m", "Frau": "f", "Señor": "m",
    "Señora": "f", "Sr": "m", "Sra": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Dr": "", "Prof": "",
    "г-н": "m", "г-жа": "f", "господин": "m", "госпожа": "f", "κ": "m", "κα": "f", "κύριος": "m", "κυρία": "f",
}
# Syllables of made-up family names.
SYLLABLES = {
    "latin": "bar den fel gor han kel lin mor nes pol rin sol tam ver wil zan".split(),
    "cyrillic": "бар вел гор дан зин кор лам мир нов пол рад сол тар фед хар яр".split(),
    "greek": "βαρ γελ δαν ζην θελ καρ λαμ μιρ νελ παλ ραν σολ ταρ φελ χαρ ψελ".split(),
}
ENDINGS = {"latin": ("", ""), "cyrillic": ("ов", "ова"), "greek": ("ης", "η")}

_NAME = r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))+"
_TITLE = "|".join(sorted(map(re.escape, TITLES), key=len, reverse=True))
# In the order in which they claim a place of the text.
PATTERNS = [
    ("secret", re.compile(r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\b[\"']?\s*[:=]\s*[\"']?)([^\s\"',;]{6,})")),
    ("secret", re.compile(r"\b((?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,}|xox[abp]-[A-Za-z0-9-]{10,})\b")),
    ("email", re.compile(r"(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})")),
    ("iban", re.compile(r"\b([A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b")),
    ("ip", re.compile(r"(?<![\w.])((?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?![\w]|\.\d)")),
    ("ssn", re.compile(r"(?<![\w-])(\d{3}-\d{2}-\d{4})(?![\w-])")),
    ("card", re.compile(r"(?<![\w-])(\d(?:[ -]?\d){12,18})(?![\w-])")),
    ("phone", re.compile(r"(?<![\w.])(\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}|0\d{2,4}[ /-]\d{3,}(?:[ -]?\d{2,})*)(?![\w])")),
    ("person", re.compile(rf"\b((?:(?:{_TITLE})\b\.?[ \u00a0]){{1,3}})((?!(?:{_TITLE})\b){_NAME}(?:[ \u00a0](?!(?:{_TITLE})\b){_NAME}){{0,2}})")),
]
# A text without any of these has no entity of the kind.
_NEEDED = {"secret": (":", "=", "AKIA", "ASIA", "gh", "sk-", "xox"), "person": tuple(TITLES)}
_DIGIT = re.compile(r"\d")
_WORD = re.compile(rf"\b{_NAME}")


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def script_of(name: str) -> str:
    first = name[0]
    if "\u0400" <= first <= "\u04ff":
        return "cyrillic"
    return "greek" if "\u0370" <= first <= "\u03ff" else "latin"


@dataclass(frozen=True)
class Entity:
    """A detected place: ``canon`` is the same wherever the same thing is meant.

    ``part`` is the number of the word of ``canon`` that stands there, if not all of it.
    """

    start: int
    end: int
    kind: str
    canon: str
    part: int | None = None


class Places:
    """Places of a text that entities have claimed; none overlaps another."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def free(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at == 0 or self.ends[at - 1] <= start

    def claim(self, start: int, end: int) -> None:
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def _bare(name: str) -> str:
    """A name without the ending of a genitive."""
    return name[:-2] if name[-2:] in ("'s", "’s") else name


def _person(titles: str, names: str, start: int) -> Entity | None:
    """The capitalised names after titles; gender from a title, else from a known given name, else ``u``."""
    held = []
    for name in re.split(r"[ \u00a0]", names):
        if not name[0].isupper():
            break
        held.append(_bare(name))
        if held[-1] != name:
            break
    if not held:
        return None
    genders = [TITLES[t] for t in re.findall(_TITLE, titles) if TITLES[t]]
    gender = genders[0] if genders else ""
    script = script_of(held[0])
    if not gender:
        known = [g for (s, g), given in GIVEN_NAMES.items() if s == script and held[0] in given]
        gender = known[0] if known else "u"
    canon = " ".join(held)
    return Entity(start, start + len(canon), f"person-{gender}", canon)


def _persons(text: str, places: Places) -> list[Entity]:
    """Names after titles, and all that the text then calls by the same names.

    A family name alone, with or without a title, is the full name before it
    that ends in it and is not of the other gender, else the first such after
    it. A full name without a title, and a common given name of one of the
    persons alone, are the person too.
    """
    titled, at = [], 0
    pattern = dict(PATTERNS)["person"]
    while m := pattern.search(text, at):
        entity = _person(m[1], m[2], m.start(2))
        at = entity.end if entity else m.start(2)
        if entity and places.free(entity.start, entity.end):
            titled.append(entity)
            places.claim(entity.start, entity.end)
    if not titled:
        return []
    heads: dict[str, dict[str, None]] = {}
    called: dict[str, list[tuple[int, Entity, int]]] = {}
    for e in titled:
        words = e.canon.split(" ")
        heads.setdefault(words[0], {})[e.canon] = None
        for part, word in enumerate(words):
            last = part == len(words) - 1
            if last or any(word in given for given in GIVEN_NAMES.values()):
                called.setdefault(word, []).append((e.start, e, part))
    # Full names before single ones: "Roe" is "John Roe" wherever a text has both.
    full = {w: [x for x in found if " " in x[1].canon] for w, found in called.items()}
    whole = {e.canon: e for e in reversed(titled)}
    out: list[Entity] = []

    def meant(word: str, start: int, kind: str | None) -> tuple[Entity, int | None] | None:
        found = full.get(word)
        if found and kind is not None and kind != "person-u":
            found = [x for x in found if x[1].kind in (kind, "person-u") and x[2] == x[1].canon.count(" ")]
        if found:
            before = bisect_left(found, start, key=lambda x: x[0])
            _, e, part = found[max(0, before - 1)]
            return e, part
        return (whole[word], None) if kind is None and word in whole else None

    for e in titled:
        other = None if " " in e.canon else meant(e.canon, e.start, e.kind)
        out.append(Entity(e.start, e.end, other[0].kind, other[0].canon, other[1]) if other else e)
    for m in _WORD.finditer(text):
        word, start = _bare(m[0]), m.start()
        if word not in heads and word not in called:
            continue
        longest = [
            c
            for c in heads.get(word, ())
            if " " in c
            and text[start : start + len(c)].replace("\u00a0", " ") == c
            and not text[start + len(c) : start + len(c) + 1].isalnum()
        ]
        if longest:
            e, part = whole[max(longest, key=len)], None
            end = start + len(e.canon)
        else:
            found = meant(word, start, None)
            if found is None:
                continue
            (e, part), end = found, start + len(word)
        if text[end : end + 1].isdigit() or text[end : end + 1] == "_" or not places.free(start, end):
            continue
        places.claim(start, end)
        out.append(Entity(start, end, e.kind, e.canon, part))
    return out


def detect(text: str) -> list[Entity]:
    """Entities of a text in order; where patterns overlap, the earlier kind has the place.

    The time is in proportion to the text, whatever it holds.
    """
    found: list[Entity] = []
    places = Places()
    digits = bool(_DIGIT.search(text))
    for kind, pattern in PATTERNS:
        if kind == "email" and "@" not in text:
            continue
        if kind in ("iban", "ip", "ssn", "card", "phone") and not digits:
            continue
        if kind in _NEEDED and not any(x in text for x in _NEEDED[kind]):
            continue
        if kind == "person":
            found += _persons(text, places)
            continue
        last = 0
        for m in pattern.finditer(text):
            start, end = m.span(1)
            if kind == "email":
                # The local part is read backwards from its @, so that no letter is read twice.
                at = start
                while start > last and (text[start - 1].isalnum() or text[start - 1] in "_.+-"):
                    start -= 1
                while start < at and not (text[start].isascii() and text[start].isalnum()):
                    start += 1
                last = end
                if start == at:
                    continue
            if not places.free(start, end):
                continue
            value = text[start:end]
            plain = re.sub(r"[^0-9A-Za-z]", "", value)
            if kind == "email":
                canon = value.lower()
            elif kind == "card":
                if not luhn(plain):
                    continue
                canon = plain
            elif kind in ("phone", "ssn", "iban"):
                if kind == "phone" and len(plain) < 7:
                    continue
                canon = plain
            else:
                canon = value
            found.append(Entity(start, end, kind, canon))
            places.claim(start, end)
    return sorted(found, key=lambda e: e.start)


class Draw:
    """Numbers below given bounds, from HMAC-SHA256 of kind, value and attempt."""

    def __init__(self, key: bytes, kind: str, canon: str, attempt: int) -> None:
        self.key, self.seed = key, f"{kind}\x00{attempt}\x00{canon}".encode()
        self.block, self.count = b"", 0

    def below(self, bound: int) -> int:
        if len(self.block) < 4:
            self.count += 1
            self.block = hmac.new(self.key, self.seed + self.count.to_bytes(4, "big"), hashlib.sha256).digest()
        number, self.block = int.from_bytes(self.block[:4], "big"), self.block[4:]
        return number % bound


def _like(value: str, draw: Draw) -> str:
    """Each letter and digit by another of its class; hexadecimal stays hexadecimal."""
    letters = [c for c in value if c.isalpha()]
    lower = "abcdef" if letters and all(c in "abcdefABCDEF" for c in letters) else "abcdefghijklmnopqrstuvwxyz"
    out = []
    for c in value:
        if c.isdigit():
            out.append(str(draw.below(10)))
        elif c.isalpha():
            new = lower[draw.below(len(lower))]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def _more(draw: Draw, attempt: int) -> str:
    """Letters to add when short names of one form run out."""
    return "".join(chr(97 + draw.below(26)) for _ in range(attempt // 8))


def surrogate(key: bytes, kind: str, canon: str, attempt: int) -> str:
    """The canonical surrogate of an entity; another for every attempt."""
    draw = Draw(key, kind, canon, attempt)
    if kind == "email":
        # The domain is drawn from itself alone: one domain stays one domain.
        local, domain = canon.split("@", 1)
        return f"{_like(local, draw)}{_more(draw, attempt)}@{surrogate(key, 'domain', domain, 0)}"
    if kind == "domain":
        host, top = canon.rsplit(".", 1)
        return f"{_like(host, draw)}{_more(draw, attempt)}.{top}"
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "card":
        body = canon[0] + "".join(str(draw.below(10)) for _ in canon[2:])
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    if kind == "iban":
        bank = _like(canon[4:], draw)
        number = "".join(str(int(c, 36)) for c in (bank + canon[:2] + "00").upper())
        return f"{canon[:2]}{98 - int(number) % 97:02d}{bank}"
    if kind == "phone":
        return canon[0] + _like(canon[1:], draw)
    if kind == "secret":
        mark = re.match(r"AKIA|ASIA|gh[pousr]_|sk-|xox[abp]-", canon)
        head = mark[0] if mark else ""
        return head + _like(canon[len(head) :], draw)
    if kind.startswith("person"):
        gender = kind[-1]
        names = canon.split(" ")
        script = script_of(names[0])
        family = "".join(SYLLABLES[script][draw.below(16)] for _ in range(3 + attempt // 4))
        family = (family + ENDINGS[script][gender == "f"]).capitalize()
        given = GIVEN_NAMES[script, gender]
        return " ".join([given[draw.below(len(given))] for _ in names[:-1]] + [family])
    return _like(canon, draw)


def in_domain(key: bytes, kind: str, canon: str, attempt: int, domain_attempt: int) -> str:
    """``surrogate``, with the domain of an e-mail address at its own attempt."""
    new = surrogate(key, kind, canon, attempt)
    if kind != "email" or not domain_attempt:
        return new
    return f"{new.split('@', 1)[0]}@{surrogate(key, 'domain', canon.split('@', 1)[1], domain_attempt)}"


def fit_format(canon: str, value: str, kind: str) -> str:
    """A canonical surrogate written the way the original stands in the text."""
    if kind in ("phone", "card", "ssn", "iban"):
        left = iter(canon)
        return "".join(next(left) if c.isalnum() else c for c in value)
    if kind == "email":
        new = [x.upper() if c.isupper() else x for c, x in zip(value, canon)]
        return "".join(new) + canon[len(value) :]
    return canon


def _entities(docs: DataFrame, text_col: str) -> DataFrame:
    """``(kind, canon)``, distinct."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                seen = {(e.kind, e.canon) for t in texts_of(part, 0) for e in detect(t.decode())}
                kinds, canons = zip(*sorted(seen)) if seen else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds, pa.string()), pa.array(canons, pa.string())], ["kind", "canon"]
                )

    return docs.select(text_col).mapInArrow(find, "kind string, canon string").distinct()


def _drawn(entities: DataFrame, key: bytes) -> DataFrame:
    """``entities`` and the surrogate ``new`` of each at its attempt."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns))
            new = [in_domain(key, *row) for row in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], [*batch.schema.names, "new"])

    return entities.select("kind", "canon", "attempt", "domain_attempt").mapInArrow(
        draw, "kind string, canon string, attempt int, domain_attempt int, new string"
    )


def _family(kind: str) -> Column:
    """Kinds whose surrogates must differ from each other: persons of both genders are one."""
    return F.when(F.col(kind).startswith("person"), "person").otherwise(F.col(kind))


def _settled(entities: DataFrame) -> DataFrame:
    """``(kind, canon, as_kind)``: persons with their gender over the whole corpus.

    A full name is one person: female if all that tells a gender says so, else
    male. A family name alone has a surrogate for each gender that a title
    tells; where none does, the corpus decides in the same way.
    """
    persons = entities.filter(F.col("kind").startswith("person"))
    of = lambda k: F.max(F.col("kind") == f"person-{k}")
    told = persons.groupBy(F.col("canon").alias("c")).agg((of("f") & ~of("m")).alias("f"))
    gender = F.when(F.col("f"), "person-f").otherwise(F.lit("person-m"))
    whole = F.contains(F.col("canon"), F.lit(" ")) | (F.col("kind") == "person-u")
    named = persons.join(told, F.col("canon") == F.col("c")).select(
        "kind", "canon", F.when(whole, gender).otherwise(F.col("kind")).alias("as_kind")
    )
    others = entities.filter(~F.col("kind").startswith("person"))
    return named.union(others.select("kind", "canon", F.col("kind").alias("as_kind")))


def _unmet(entities: DataFrame, key: bytes) -> DataFrame:
    """``(kind, canon, attempt)`` of ``entities (kind, canon, domain_attempt)``.

    A surrogate belongs to the entity that draws it at the lowest attempt, of
    these to the least; it must not be an entity itself. All others draw again,
    until none is left. Only losers are carried on; groups are pre-aggregated.
    """
    drawn = _drawn(entities.withColumn("attempt", F.lit(0)), key).checkpoint()
    real = entities.select(_family("kind").alias("k"), F.col("canon").alias("c")).distinct()
    while True:
        owner = drawn.groupBy(_family("kind").alias("family"), "new").agg(
            F.min(F.struct("attempt", "canon", "kind")).alias("o"), F.count(F.lit(1)).alias("n")
        )
        clash = (
            owner.join(real, (F.col("family") == F.col("k")) & (F.col("new") == F.col("c")), "left")
            .filter("n > 1 or c is not null")
            .select(F.col("family").alias("k2"), F.col("new").alias("n2"), "o", F.col("c").isNotNull().alias("is_real"))
        )
        marked = drawn.join(clash, (_family("kind") == F.col("k2")) & (F.col("new") == F.col("n2")), "left")
        other = (F.col("canon") != F.col("o.canon")) | (F.col("kind") != F.col("o.kind"))
        lost = F.col("o").isNotNull() & (F.col("is_real") | other)
        after = marked.select(*drawn.columns, F.coalesce(lost, F.lit(False)).alias("lost")).checkpoint()
        losers = after.filter("lost")
        if losers.isEmpty():
            return after.select("kind", "canon", "attempt")
        again = _drawn(losers.withColumn("attempt", F.col("attempt") + 1), key)
        drawn = after.filter("not lost").drop("lost").union(again).checkpoint()


def retries(entities: DataFrame, key: bytes) -> DataFrame:
    """``(kind, canon, as_kind, attempt)`` of entities whose first surrogate is not theirs, or whose kind is not.

    The domains of e-mail addresses are entities of their own, kind ``domain``,
    and have their surrogates before the addresses have.
    """
    ensure_checkpoint_dir(entities.sparkSession)
    settled = _settled(entities).checkpoint()
    domain = F.substring_index("canon", "@", -1)
    hosts = settled.filter("kind = 'email'").select(F.lit("domain").alias("kind"), domain.alias("canon")).distinct()
    hosts = _unmet(hosts.withColumn("domain_attempt", F.lit(0)), key)
    tries = hosts.filter("attempt > 0").select(F.col("canon").alias("host"), F.col("attempt").alias("host_attempt"))
    things = settled.select(F.col("as_kind").alias("kind"), "canon").distinct()
    held = things.join(tries, (F.col("kind") == "email") & (domain == F.col("host")), "left")
    done = _unmet(held.select("kind", "canon", F.coalesce("host_attempt", F.lit(0)).alias("domain_attempt")).checkpoint(), key)
    done = done.withColumnsRenamed({"kind": "as_kind", "canon": "as_canon"})
    found = settled.withColumnsRenamed({"kind": "kind_", "as_kind": "as_"}).join(
        done, (F.col("as_") == F.col("as_kind")) & (F.col("canon") == F.col("as_canon"))
    )
    first = F.when(F.col("kind_") == "person-u", DEFAULT_PERSON).otherwise(F.col("kind_"))
    changed = found.filter((F.col("attempt") > 0) | (F.col("as_kind") != first))
    return changed.select(F.col("kind_").alias("kind"), "canon", "as_kind", "attempt").union(
        hosts.filter("attempt > 0").select("kind", "canon", F.col("kind").alias("as_kind"), "attempt")
    )


def replace_entities(text: str, key: bytes, attempts: dict[tuple[str, str], tuple[str, int]]) -> tuple[str, int]:
    """The text with every entity replaced, and how many there were."""
    out, last = [], 0
    found = detect(text)
    for e in found:
        first = DEFAULT_PERSON if e.kind == "person-u" else e.kind
        kind, attempt = attempts.get((e.kind, e.canon), (first, 0))
        host = attempts.get(("domain", e.canon.split("@", 1)[1]), ("", 0))[1] if kind == "email" else 0
        new = in_domain(key, kind, e.canon, attempt, host)
        if e.part is not None:
            new = new.split(" ")[e.part]
        out += [text[last : e.start], fit_format(new, text[e.start : e.end], e.kind)]
        last = e.end
    out.append(text[last:])
    return "".join(out), len(found)


def _retries_by_text(docs: DataFrame, text_col: str, again: DataFrame) -> DataFrame:
    """``(h, again)``: the retries of each text that holds any, by the hash of the text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                rows = [
                    (h, *thing)
                    for h, t in zip(part.column(1).to_pylist(), texts_of(part, 0))
                    for e in detect(t.decode())
                    for thing in [(e.kind, e.canon), *([("domain", e.canon.split("@", 1)[1])] if e.kind == "email" else [])]
                ]
                columns = zip(*dict.fromkeys(rows)) if rows else ((), (), ())
                kinds = (pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], ["h", "kind", "canon"]
                )

    held = docs.select(text_col, F.xxhash64(text_col).alias("h")).mapInArrow(
        find, "h bigint, kind string, canon string"
    )
    return held.join(again, ["kind", "canon"]).groupBy("h").agg(
        F.collect_set(F.struct("kind", "canon", "as_kind", "attempt")).alias("again")
    )


def replace_personal_data(
    docs: DataFrame,
    key: bytes,
    text_col: str = "text",
    count_col: str | None = None,
    broadcast_retries: int = BROADCAST_RETRIES,
) -> DataFrame:
    """``docs`` with personal data in the text replaced; other columns stay as they are.

    Found are e-mail and IP addresses, phone, card, social security and bank
    account numbers, keys and passwords, and names after a title with all that
    the text calls the same persons (see ``_persons``). A surrogate
    is drawn with ``key`` from the kind and the canonical value, so a thing has
    one surrogate in all texts, a full name whatever its titles, and it keeps script, gender, length, classes of
    characters, separators and check digits. Two things never share one, and
    none is a value that occurs: collisions are found over the whole corpus and
    drawn again. The few redrawn ones reach the texts by a broadcast of at most
    ``broadcast_retries`` entries, or else by a join.

    A null text stays null, an empty one empty. Repeated rows give equal
    results. ``count_col`` names a column for the number of places replaced.
    """
    found = written(_entities(docs, text_col), "entities")
    again = retries(found, key).checkpoint()
    discard(found)
    few = again.count() <= broadcast_retries
    names = list(docs.columns)
    at, width = names.index(text_col), len(names)
    out_names = [*names, count_col] if count_col else names
    if few:
        rows = again.collect()
        shared = docs.sparkSession.sparkContext.broadcast(
            {(r["kind"], r["canon"]): (r["as_kind"], r["attempt"]) for r in rows}
        )
        source = docs
    else:
        shared = None
        by_text = _retries_by_text(docs, text_col, again).withColumnsRenamed({"h": "h again", "again": "retry list"})
        source = docs.join(by_text, F.xxhash64(docs[text_col]) == F.col("h again"), "left").drop("h again")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                lists = None if few else part.column(part.num_columns - 1).to_pylist()
                out, counts = [], []
                for row, text in enumerate(part.column(at).to_pylist()):
                    if few:
                        attempts = shared.value
                    else:
                        attempts = {(x["kind"], x["canon"]): (x["as_kind"], x["attempt"]) for x in lists[row] or ()}
                    new, n = (None, 0) if text is None else replace_entities(text, key, attempts)
                    out.append(new)
                    counts.append(n)
                columns = list(part.columns[:width])
                columns[at] = pa.array(out, pa.string())
                if count_col:
                    columns.append(pa.array(counts, pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, out_names)

    fields = [*docs.schema.fields, *([T.StructField(count_col, T.LongType())] if count_col else [])]
    return source.mapInArrow(replace, T.StructType(fields))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_personal_data(docs, b"rotate-me", count_col="n_replaced")
