"""Personal data replaced by surrogates: keyed, of the same kind, one for each real value.

Values are found by patterns with their checks (Luhn for cards, modulo 97 for IBANs, ranges for
addresses of machines). Every different value of the corpus is one entity, whatever its spelling; it gets
a surrogate drawn from a keyed hash, which matches its kind: gender and script for names, the number of
digits, the check digits and the country code for numbers, letters for letters in addresses. Draws that
meet another entity's surrogate, or a value that really occurs, are drawn again, by joins over all
entities, until none does; so different values stay different, equal ones stay equal in all texts, and no
surrogate is somebody's real value. In a text the surrogate takes over spelling, case and separators.

Only entities are shuffled, and the texts that may hold any; the others pass as they are. A text's
entities are the only group that is collected, and it is no larger than the text.

Defined results: a null text stays null, an empty one empty, both without entities; repeated rows are
replaced alike; an empty table gives an empty result. The same key gives the same surrogates over the
same values.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator
from secrets import token_bytes

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lake_ingest.llm.blocks import batch
from lake_ingest.llm.shared import saved

# Draws after which letters are added to make room where too few values have the format, and after which the
# formats that take no letters are exhausted.
PATIENCE = 6
MOST_DRAWS = 60
DIGITS = "0123456789"

# Titles by the gender they tell, and given names by gender and script.
TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Sir", "г-н"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Señorita", "г-жа"),
    "n": ("Dr", "Prof"),
}
GIVEN = {
    ("m", "latin"): "Adam Bruno Carl David Emil Felix Georg Henry Ivan Jonas Karl Louis Martin Nils Oscar Paul Robert Simon Thomas Victor".split(),
    ("f", "latin"): "Alice Beate Clara Diana Emma Flora Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula Rosa Sofia Teresa Vera".split(),
    ("n", "latin"): "Alex Andrea Chris Dana Gabriel Jamie Jean Kim Luca Noel Robin Sam Sascha Toni Val".split(),
    ("m", "cyrillic"): "Александр Борис Виктор Григорий Дмитрий Егор Иван Кирилл Леонид Михаил Николай Олег Павел Роман Сергей".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лариса Мария Нина Ольга Полина София".split(),
    ("n", "cyrillic"): "Женя Саша Валя Слава Шура".split(),
}
SYLLABLES = {
    "latin": ("ba be bo da de do fa fe ga go ha he ka ke la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve wa we za".split(), ("n", "r", "s", "l", "ck", "tt"), "a"),
    "cyrillic": ("ба бе бо ва ве да де до ка ко ла ле ло ма ме мо на не но па по ра ре ро са се со та те то".split(), ("в", "н", "к", "р", "л"), "а"),
}

_TITLE = "|".join(sorted((t for titles in TITLES.values() for t in titles), key=len, reverse=True))
_NAME = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][\w'’]*(?:-[A-ZÀ-ÖØ-ÞА-ЯЁ][\w'’]*)?"
PATTERN = re.compile(
    r"(?P<iban>\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<email>\w(?:[\w.+-]*\w)?@\w+(?:-\w+)*(?:\.\w+(?:-\w+)*)+)"
    r"|(?P<ip>(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\w|\.[0-9]))"
    r"|(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))"
    r"|(?P<card>(?<![\w.-])(?:[0-9]{13,19}|[0-9]{4}(?P<gap>[ -])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![\w-]))"
    r"|(?P<phone>(?<![\w+])\+[0-9]{1,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?!\w)"
    r"|(?<![\w+])\+[0-9]{8,15}(?!\w)"
    r"|(?<![\w+])\+[0-9]{1,3}(?P<mark>[ .-])[0-9]{1,4}(?:(?P=mark)[0-9]{2,4}){1,3}(?!\w)"
    r"|(?<![\w+])\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?!\w)"
    r"|(?<![\w.+-])[0-9]{3}(?P<dash>[.-])[0-9]{3,4}(?P=dash)[0-9]{4}(?![\w-]))"
    rf"|\b(?P<title>{_TITLE})\b\.?[ \t]+(?P<one>{_NAME})(?:[ \t]+(?P<two>{_NAME}))?"
)
# Texts in which none of this occurs hold no entity.
MAY_HOLD = rf"[0-9@]|\b({_TITLE})\b"
ENTITY = "kind string, value string"


def _luhn(digits: str) -> bool:
    doubled = (int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits)))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _iban_rest(value: str) -> int:
    """Remainder of an IBAN modulo 97, its head moved to the end and letters counted from 10 on."""
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def _script(text: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in text) else "latin"


def entities(text: str) -> Iterator[tuple[int, int, str, str]]:
    """``(start, end, kind, value)`` of the personal data of a text; the value is the same for all spellings."""
    for match in PATTERN.finditer(text):
        kind, surface = match.lastgroup, match.group()
        if match["title"]:
            gender = next(g for g, titles in TITLES.items() if match["title"] in titles)
            if match["two"]:
                yield (*match.span("one"), f"given {gender}", match["one"].casefold())
            last = "two" if match["two"] else "one"
            yield (*match.span(last), "surname", match[last].casefold())
            continue
        kind = next(k for k in ("iban", "email", "ip", "ssn", "card", "phone") if match[k])
        digits = re.sub("[^0-9]", "", surface)
        if kind == "email":
            yield (*match.span(), kind, surface.lower())
        elif kind == "ip":
            if all(int(part) < 256 for part in surface.split(".")):
                yield (*match.span(), kind, surface)
        elif kind == "iban":
            value = surface.replace(" ", "")
            if 15 <= len(value) <= 34 and _iban_rest(value) == 1:
                yield (*match.span(), kind, value)
        elif kind == "card":
            if digits[0] in "23456" and _luhn(digits):
                yield (*match.span(), kind, digits)
        elif kind != "phone" or 8 <= len(digits) <= 15:
            yield (*match.span(), kind, ("+" if surface[0] == "+" else "") + digits)


class Draws:
    """A stream of numbers from a keyed hash."""

    def __init__(self, key: bytes, *parts: object):
        self.state = hmac.new(key, "\0".join(map(str, parts)).encode(), hashlib.sha256).digest()

    def below(self, n: int) -> int:
        self.state = hashlib.sha256(self.state).digest()
        return int.from_bytes(self.state[:8], "big") % n

    def of(self, values):
        return values[self.below(len(values))]

    def digits(self, n: int) -> str:
        return "".join(str(self.below(10)) for _ in range(n))


def _like(value: str, draws: Draws) -> str:
    """Letters for letters and digits for digits, everything else as it is."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    return "".join(
        str(draws.below(10)) if c in DIGITS else draws.of(letters) if c.isalpha() else c for c in value
    )


def _made_up(script: str, draws: Draws, gender: str, more: int) -> str:
    syllables, ends, female = SYLLABLES[script]
    stem = "".join(draws.of(syllables) for _ in range(2 + more))
    return stem + (female if gender == "f" else draws.of(ends))


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The value that stands for an entity at a given draw."""
    draws = Draws(key, kind, value, attempt)
    more = max(0, attempt - PATIENCE)
    if kind == "email":
        local, _, domain = value.partition("@")
        name, _, top = domain.rpartition(".")
        held = Draws(key, "domain", domain, 0)
        return f"{_like(local, draws)}{_like('a' * more, draws)}@{_like(name, held)}.{top}"
    if kind == "ip":
        return ".".join(str(1 + draws.below(254)) for _ in range(4))
    if kind == "card":
        body = value[0] + draws.digits(len(value) - 2)
        return next(body + c for c in DIGITS if _luhn(body + c))
    if kind == "iban":
        body = _like(value[4:].lower(), draws).upper()
        return f"{value[:2]}{98 - _iban_rest(value[:2] + '00' + body):02d}{body}"
    if kind == "phone":
        kept = 0 if value[0] != "+" else 2 if value[1] in "17" else 3
        return value[:kept] + str(1 + draws.below(9)) + draws.digits(len(value) - kept - 1)
    if kind == "ssn":
        return str(9) + draws.digits(len(value) - 1)
    script = _script(value)
    if kind == "surname":
        return _made_up(script, draws, "n", more)
    gender = kind.split()[1]
    return draws.of(GIVEN[gender, script]).casefold() if attempt < 3 else _made_up(script, draws, gender, more)


def rendered(surface: str, kind: str, value: str) -> str:
    """A surrogate in the spelling of what it replaces."""
    if kind in ("card", "phone", "ssn"):
        digits = iter(re.sub("[^0-9]", "", value))
        return "".join(next(digits) if c in DIGITS else c for c in surface)
    if kind == "iban":
        signs = iter(value)
        return "".join(c if c == " " else next(signs) for c in surface)
    if surface.isupper() and len(surface) > 1:
        return value.upper()
    if kind == "surname" or kind.startswith("given"):
        return value[:1].upper() + value[1:]
    return value


def _key_of(text: str):
    return F.unhex(F.sha2(text, 256))


def _found(batches):
    for rows in batches:
        keys, kinds, values = [], [], []
        for key, text in zip(rows["key"].to_pylist(), rows["text"].to_pylist()):
            for kind, value in {(k, v) for _, _, k, v in entities(text)}:
                keys.append(key)
                kinds.append(kind)
                values.append(value)
        yield batch(key=pa.array(keys, pa.binary()), kind=pa.array(kinds, pa.string()), value=pa.array(values, pa.string()))


def assigned(values: DataFrame, key: bytes) -> DataFrame:
    """``(kind, value, surrogate)`` for different ``(kind, value)``: no two alike, and none a real value.

    An error after ``MOST_DRAWS`` draws: then the values of a kind are about as many as its format has.
    """

    def draw(attempt: int):
        def drawn(batches):
            for rows in batches:
                pairs = zip(rows["kind"].to_pylist(), rows["value"].to_pylist())
                made = [surrogate(key, kind, value, attempt) for kind, value in pairs]
                yield batch(kind=rows["kind"], value=rows["value"], surrogate=pa.array(made, pa.string()))

        return drawn

    real = values.select("kind", F.col("value").alias("surrogate"))
    todo, done, attempt = values, None, 0
    while True:
        made = saved(todo.mapInArrow(draw(attempt), f"{ENTITY}, surrogate string"), "draws")
        first = made.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        free = first.join(real, ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        good = saved(free.select("kind", "value", "surrogate"), "surrogates")
        done = good if done is None else done.unionByName(good)
        todo = made.select("kind", "value").join(good.select("kind", "value"), ["kind", "value"], "left_anti")
        attempt += 1
        left = todo.first()
        if left is None:
            return done
        if attempt == MOST_DRAWS:
            raise ValueError(f"too many values of kind {left.kind!r} for surrogates of their format")


def _replaced(batches):
    for rows in batches:
        texts, counts = [], []
        for text, known in zip(rows["_text"].to_pylist(), rows["_known"].to_pylist()):
            chosen = {(k["kind"], k["value"]): k["surrogate"] for k in known or ()}
            out, at, n = [], 0, 0
            for start, end, kind, value in entities(text):
                out += [text[at:start], rendered(text[start:end], kind, chosen[kind, value])]
                at, n = end, n + 1
            texts.append("".join([*out, text[at:]]))
            counts.append(n)
        row = rows["_row"]
        yield batch(_row=row, _new=pa.array(texts, pa.string()), n_entities=pa.array(counts, pa.int64()))


def surrogates(docs: DataFrame, text: str = "text", *, key: bytes | None = None) -> DataFrame:
    """The rows of ``docs`` with the text replaced, and ``n_entities``, the number of replacements.

    Whoever has ``key`` can find values by trial, so it is the caller's to choose and keep; without one a key
    is drawn for this call alone, and the same value gets another surrogate in the next.
    """
    key = key or token_bytes(32)
    columns = docs.columns
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_row"), F.col(text).alias("_text"))
    may = F.coalesce(F.col("_text").rlike(MAY_HOLD), F.lit(False))
    some = whole.where(may).withColumn("key", _key_of("_text"))
    occurring = saved(
        some.select("key", F.col("_text").alias("text")).mapInArrow(_found, f"key binary, {ENTITY}").distinct(),
        "entities",
    )
    chosen = assigned(occurring.select("kind", "value").distinct(), key)
    known = (
        occurring.join(chosen, ["kind", "value"])
        .groupBy("key")
        .agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("_known"))
    )
    held = some.join(known, "key").select("_row", "_text", "_known")
    row = T.StructField("_row", whole.schema["_row"].dataType)
    schema = T.StructType([row, T.StructField("_new", T.StringType()), T.StructField("n_entities", T.LongType())])
    changed = held.mapInArrow(_replaced, schema)
    others = some.join(known.select("key"), "key", "left_anti").select("_row").unionByName(
        whole.where(~may).select("_row")
    )
    unchanged = others.select("_row", F.col(f"_row.`{text}`").alias("_new"), F.lit(0).cast("long").alias("n_entities"))
    every = changed.unionByName(unchanged)
    return every.select(
        *(F.col("_new").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in columns), "n_entities"
    )
