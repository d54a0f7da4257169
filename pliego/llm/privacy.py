"""Problem 5: personal information inside free text, by information-theoretic sanitisation.

Some terms give a person away by their form alone: addresses of mail, numbers grouped like a telephone's,
identity numbers with their letter.  They are the protected entities whose company is then measured over
the whole corpus.  A word that stands in a capitalised run before such a number far more often than chance
discloses a person: its disclosure is the share of its occurrences in that company, and sequences of
disclosing words are names.  The word before a number discloses the number's class likewise: bare digits
count as a telephone number where grouped ones stand too.  Terms above the thresholds are replaced by
typed placeholders.  Counts are by the word, and decide about every word.  Decisions go to all workers, unless
there are more than KEPT; then those about words that make up more than one in KEPT of the corpus do, which are
KEPT at most, and each text is lent those about its other words by a join.  The results are the same.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pliego.llm.spark import columns, drop, lent, prepare, stored

#: Decisions that go to all workers at most.
KEPT = 1 << 21
#: Least disclosure of a word of a name, least occurrences in company, least share for the word before a number.
DISCLOSES, LEAST, LABEL = 0.03, 3, 0.15
#: Share of occurrences at the start of a line or sentence from which a capital letter says nothing, and
#: share in capitals from which a word is a proper one.
STARTS, PROPERLY = 0.9, 0.8
#: Share of all capitalised words up to which a word is uncommon.
RARE = 2e-4

# -- fixed values ------------------------------------------------------------------------------------
#: Letters that end an identity number (23 of the alphabet).
CONTROL = "TRWAGMYFPDXBNJZSQVHLCKE"
STREET = r"calle|c/|c\.|cl\.?|avenida|avda\.?|av\.|avinguda|plaza|pza\.?|pl\.|plaça|praza|paseo|pº|p\.º|passeig|carretera|ctra\.?|ronda|rúa|rua|carrer|camino|cno\.?|travesía|travesia|trva\.?|glorieta|gta\.?|callejón|rambla|bulevar|cuesta|pasaje|vía|kalea"
#: Words before a name that make it part of a body, prize, building or street.
HEADS = {"fundación", "fundacion", "fundació", "fdn", "fund", "premio", "premios", "beca", "becas", "biblioteca", "pública", "publica", "colegio", "instituto", "centro", "hospital", "calle", "plaza", "avenida", "avda", "paseo", "rúa", "ronda", "camino", "poeta", "museo", "parque", "cátedra", "escuela", "universidad", "edificio", "sala", "asociación", "empresa", "legado", "casa", "archivo", "polideportivo", "pabellón", "auditorio", "teatro", "concurso", "certamen", "memorial", "trofeo", "residencia"}
#: Forms of address that look like an initial.
ADDRESS = {"D", "Dª"}

WORD = re.compile(r"[^\W\d_]+(?:['’·][^\W\d_]+)*")
CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ][^\W\d_]*(?:['’·][^\W\d_]+)*")
START = re.compile(r"(?:^|[\n.:;!?»)–—|] ?)([A-ZÀ-ÖØ-Þ][^\W\d_]+)")
_AT = r"(?: ?@ ?| ?[\[(] ?(?:at|arroba) ?[\])] ?| arroba | at )"
_DOT = r"(?:\.|[\[(] ?(?:punto|dot) ?[\])]| punto | dot )"
EMAIL = re.compile(rf"[\w+-]+(?:{_DOT}[\w+-]+)*{_AT}[\w-]+(?:{_DOT}[\w-]+)+", re.I)
#: What every address of mail holds.
AT = re.compile(r"@|[\[(] ?[aA][tT] ?[\])]|[aA][rR][rR][oO][bB][aA]| [aA][tT] ")
#: What every number of interest holds.
DIGITS = re.compile(r"\d[\d .()-]{4,}\d")
PHONE = re.compile(r"(?<![\w.,/@+-])(?:(?:\(\+34\)|\+34|0034|34(?=-))[ .-]?)?\(?\d(?:[ .()-]{0,2}\d){8}(?![\w@]|[.,/-]\d)")
IDENTITY = re.compile(rf"(?<![\w.,/-])(?:(\d{{2}}[. ]?\d{{3}}[. ]?\d{{3}}[ -]?[{CONTROL}]|[XYZ][ -]?\d[. ]?\d{{3}}[. ]?\d{{3}}[ -]?[{CONTROL}])|([A-Z]{{3}}[ -]?\d{{6}}))(?![\w])", re.I)
_CAP = r"[A-ZÀ-ÖØ-Þ][^\W\d_]*"
_SMALL = r"(?:de la |de los |de las |de el |del |de |la |los |las |el |DE LA |DE LOS |DE LAS |DE EL |DEL |DE |LA |LOS |LAS |EL )?"
ADDRESSES = re.compile(
    rf"(?<![\w])(?:(?i:{STREET})) ?{_SMALL}{_CAP}(?:(?: de | del | de la | y | DE | DEL | DE LA | Y |[ -]){_CAP})*"
    r"(?:,? ?(?:(?:[nN]\.?[º°o]\.?|[nN][úÚuU][mM]\.|[nN][úÚuU][mM][eE][rR][oO]) ?)?\d{1,4}(?! ?\d{3}\b)(?: ?(?i:bis|dpdo|dup)\b)?|,? (?:km|KM|Km)\.? ?\d{1,3}(?:[.,]\d{1,3})?|,? ?[sS]/[nN]\b)"
    r"(?:(?:, | - | )(?i:\d{1,2}[ªºa°.][ª º°]?(?:planta)?(?: ?(?:izda|dcha|centro|ext|int)\b| [A-H]\b)?|\d{1,2}\.[ºª] ?[A-H]\b|piso \d{1,2}|puerta \w{1,2}\b|esc\.? \w{1,2}\b|escalera \w{1,2}\b|bajo\b|entlo\b|entresuelo\b|ático\b|atico\b|local \w{1,2}\b|portal \w{1,2}\b|bloque \w{1,2}\b|planta \w{1,2}\b))*"
    rf"(?:(?:, | - |\. | )\d{{5}} {_CAP}(?:(?: de la | de los | del | de |-){_CAP})*)?"
)
JOIN = re.compile(r"(?:-| )(?:(?:de la|de los|de las|del|de|DE LA|DE LOS|DE LAS|DEL|DE) )?\Z")
BEFORE_RUN = re.compile(rf"((?:{_CAP}|[A-Z]\.)(?:(?: |-|, | de la | del | de |-de la )(?:{_CAP}|[A-Z]\.))+)[,;]?(?: [a-zà-ÿ]+){{0,4}}(?: (?:DNI|NIE|NIF))?:? ?[(|<]? ?\Z")


#: Counts of a word: in company, capitalised, in lower case, at starts, first of a run, in runs, numbers after it by form and in all.
COUNTS = ["company", "capitals", "lower", "at_start", "first", "in_run", "formed", "numbers"]
COMPANY, CAPITALS, LOWER, AT_START, FIRST, IN_RUN, FORMED, NUMBERS = range(len(COUNTS))
#: Decisions about a word, as bits, and those about one that has none.
PERSON, GIVEN, PROPER, RARELY, LABELS = 1, 2, 4, 8, 16
UNKNOWN = PROPER | RARELY


def label(text: str, at: int) -> str:
    """The word, or sign, before a number."""
    head = text[max(0, at - 40) : at].rstrip()
    if head and not head[-1].isalpha() and head[-1] in "|(<":
        return head[-1]
    found = WORD.findall(head)
    return found[-1].lower() if found else ""


def emails(text: str):
    """(from, to) of the addresses of mail."""
    end = 0
    for at in AT.finditer(text):
        if at.start() < end:
            continue
        for m in EMAIL.finditer(text, max(end, at.start() - 80), at.end() + 120):
            if m.start() < at.start() < m.end():
                yield m.span()
                end = m.end()
                break


def near(pattern: re.Pattern, text: str):
    """Matches of a pattern of numbers, sought only around digits."""
    end = 0
    for z in DIGITS.finditer(text):
        if z.start() < end:
            continue
        for m in pattern.finditer(text, max(end, z.start() - 7), min(len(text), z.end() + 12)):
            yield m
            end = m.end()


def phones(text: str):
    """(from, to, formed) of what might be a telephone number; formed: with prefix, brackets or groups."""
    for m in near(PHONE, text):
        raw = m[0]
        digits = re.sub(r"\D", "", raw)
        prefixed = len(digits) > 9
        if prefixed and not digits.startswith(("34", "0034")) or digits[-9] not in "6789":
            continue
        if raw.count("(") != raw.count(")"):
            continue
        tail = text[m.end() : m.end() + 6].lstrip().lower()
        if tail.startswith(("€", "eur")):
            continue
        yield m.start(), m.end(), prefixed or not raw.isdigit()


def identities(text: str):
    """(from, to, formed) of what might be an identity number; formed: with digits and letter as the card has them."""
    for m in near(IDENTITY, text):
        yield m.start(), m.end(), m[1] is not None


class Counts:
    """What one task has counted."""

    def __init__(self):
        self.table: defaultdict[str, list[int]] = defaultdict(lambda: [0] * len(COUNTS))
        self.words: Counter = Counter()
        self.starts: Counter = Counter()

    def flush(self) -> None:
        for w, n in self.words.items():
            self.table[w.lower()][LOWER if w[0].islower() else CAPITALS] += n
        for w, n in self.starts.items():
            self.table[w.lower()][AT_START] += n
        self.words.clear(), self.starts.clear()

    def batch(self) -> pa.RecordBatch:
        """What has been counted, which is forgotten."""
        self.flush()
        numbers = np.array(list(self.table.values()), np.int64).reshape(-1, len(COUNTS))
        out = pa.RecordBatch.from_arrays([pa.array(list(self.table), pa.string()), *map(pa.array, np.ascontiguousarray(numbers.T))], names=["word", *COUNTS])
        self.table.clear()
        return out

    def add(self, text: str) -> None:
        self.words.update(WORD.findall(text))
        self.starts.update(START.findall(text))
        if len(self.words) > 100_000:
            self.flush()
        anchors = []
        for kind, found in (("i", identities(text)), ("p", phones(text))):
            for a, b, formed in found:
                of = self.table[kind + "\t" + label(text, a)]
                of[NUMBERS] += 1
                if formed:
                    of[FORMED] += 1
                    if kind == "i":
                        anchors.append(a)
        anchors += [a for a, _ in emails(text) if text[max(0, a - 1) : a] == "("]
        for a in anchors:
            head = text[max(0, a - 110) : a]
            m = BEFORE_RUN.search(head[head.rfind("\n") + 1 :])
            if m:
                words = [w.lower() for w in WORD.findall(m[1]) if len(w) > 1 and w[0].isupper()]
                unclear = "," in m[1] or "." in m[1]  # surnames first, or initials
                lead = 1 if m.start() == 0 and len(words) > 2 else 0  # a capital at the start of the line may be no name's
                for k, w in enumerate(words):
                    of = self.table[w]
                    of[COMPANY] += 1
                    if not unclear:
                        of[IN_RUN] += 1
                        of[FIRST] += k <= lead


class Disclosure:
    """The decisions about words: their numbers, sorted, and bits; and those lent to the texts at hand."""

    def __init__(self, numbers: np.ndarray, bits: np.ndarray):
        self.numbers, self.bits = numbers, bits
        self.cache: dict[str, int] = {}
        self.lent: dict[int, int] = {}

    def lend(self, decisions: pa.ListArray) -> None:
        """Takes the decisions about the other words of a batch of texts, in place of the batch's before."""
        of = decisions.flatten()
        self.lent = dict(zip(of.field("number").to_pylist(), of.field("bits").to_pylist()))

    def own(self, low: str) -> tuple[int, int]:
        """The number of a word, and its bits, -1 if it has none here."""
        n = xxhash.xxh64_intdigest(low.encode(), 42)
        n -= n >> 63 << 64
        k = int(np.searchsorted(self.numbers, np.int64(n)))
        return n, int(self.bits[k]) if k < len(self.numbers) and self.numbers[k] == n else -1

    def of(self, word: str) -> int:
        low = word.lower()
        found = self.cache.get(low)
        if found is None:
            if len(self.cache) > 300_000:
                self.cache.clear()
            n, found = self.own(low)
            found = self.cache[low] = found if found >= 0 else self.lent.get(n, UNKNOWN)
        return found

    def names(self, text: str, taken: list[tuple[int, int]]):
        """(from, to) of the names outside the spans already taken."""
        people = []
        for m in CAPITAL.finditer(text):
            if len(m[0]) < 2:
                continue
            of = self.of(m[0])
            if not of & PERSON:
                # an uncommon proper word that goes on with a name belongs to it
                if not (people and of & UNKNOWN == UNKNOWN and m.start() - people[-1][1] <= 9):
                    continue
                j = JOIN.match(text, people[-1][1], m.start())
                if not (j and j.end() == m.start()):
                    continue
            people.append((m.start(), m.end()))
        k, n = 0, len(people)
        while k < n:
            a, b = people[k]
            run = [k]
            while k + 1 < n and people[k + 1][0] - b <= 9 and JOIN.match(text, b, people[k + 1][0]) and JOIN.match(text, b, people[k + 1][0]).end() == people[k + 1][0]:
                k += 1
                b = people[k][1]
                run.append(k)
            k += 1
            is_given = [bool(self.of(text[people[r][0] : people[r][1]]) & GIVEN) for r in run]
            # surnames, given names
            inverted = False
            if not any(is_given) and k < n and text[b : people[k][0]] == ", " and self.of(text[people[k][0] : people[k][1]]) & GIVEN:
                j, e = k, people[k][1]
                while j + 1 < n and text[e : people[j + 1][0]] == " " and self.of(text[people[j + 1][0] : people[j + 1][1]]) & GIVEN:
                    j += 1
                    e = people[j][1]
                after = text[e : people[j + 1][0]] if j + 1 < n else ""
                if after not in (" ", "-", " de la "):
                    run += range(k, j + 1)
                    k, b, inverted = j + 1, e, True
            # initials before it
            size = len(run)
            if not is_given[0] or size == 1:
                while a >= 3 and text[a - 1] == " " and text[a - 2] == "." and text[a - 3].isupper() and (a == 3 or not (text[a - 4].isalnum() or text[a - 4] in ".ª")):
                    if text[a - 3] in ADDRESS and (inverted or is_given[0] or size > len(run)):
                        break
                    a -= 3
                    size += 1
            if not is_given[0] and not inverted and size == len(run) and a >= 2 and text[a - 1] == " " and text[a - 2].isalpha():
                # an uncommon word with a capital in front of surnames is a first name
                w = text[text.rfind(" ", 0, a - 1) + 1 : a - 1].lstrip("(«\"–")
                if CAPITAL.fullmatch(w) and self.of(w) & UNKNOWN == UNKNOWN and w.lower() not in HEADS and a - 1 - len(w) > text.rfind("\n", 0, a) + 1:
                    a -= len(w) + 1
                    size += 1
            size = len(run) + (size > len(run))
            if size < 2 or any(s < b and e > a for s, e in taken):
                continue
            head = text[max(0, a - 40) : a]
            head = head[head.rfind("\n") + 1 :]
            before = WORD.findall(head)
            if before and head[-1:] == " " and head[-2:-1] not in (",", ":", ";", "|", "–", "("):
                w = before[-1]
                if w.lower() in HEADS or (head[-2:-1] != "." and w[0].isupper() and self.of(w) & PROPER and not self.of(w) & PERSON):
                    continue
                if len(before) > 1 and before[-2].lower() in HEADS and w.islower() and len(w) <= 3:
                    continue
            after = WORD.match(text, b + 2) if text[b : b + 2] == ", " else None
            if after and after[0].lower() in HEADS:
                continue
            yield a, b

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(class, from, to) in order of place; of overlapping ones the more specific stays."""
        found: list[tuple[str, int, int]] = []
        taken: list[tuple[int, int]] = []

        def put(kind: str, a: int, b: int) -> None:
            if not any(s < b and e > a for s, e in taken):
                found.append((kind, a, b))
                taken.append((a, b))

        for a, b in emails(text):
            put("email", a, b)
        for a, b, formed in identities(text):
            if formed or self.of("i\t" + label(text, a)) & LABELS:
                put("identidad", a, b)
        for a, b, formed in phones(text):
            if formed or self.of("p\t" + label(text, a)) & LABELS:
                put("telefono", a, b)
        for m in ADDRESSES.finditer(text):
            inner = WORD.findall(m[0])[1:]
            if m[0].isupper() and len(inner) > 3 and sum(not self.of(w) & PROPER for w in inner if len(w) > 3) > 2 and not re.search(r", ?(?:N|KM|S/N|\d)", m[0]):
                continue  # capitals all over the line, and words that aren't proper elsewhere
            put("direccion", *m.span())
        for a, b in self.names(text, list(taken)):
            put("nombre", a, b)
        found.sort(key=lambda s: s[1])
        return found


#: What a line (of Latin letters) holds in which a window of 40 characters may cut a word and hold no other: more than 20 characters without a word, or of one.
CUT = re.compile(r"[^A-Za-z\n]{21}|[A-Za-z\xaa-\xff'’·]{21}")
#: Letters whose capitals CAPITAL doesn't know, and a word in capitals of four letters or more.
OTHER, SHOUTED = re.compile(r"[^\W\d_\x00-\xff]"), re.compile(r"[A-ZÀ-ÖØ-Þ][^\W\d_a-zß-öø-ÿ]{3}")


def asked(text: str) -> set[str]:
    """The words, in lower case, that `spans` may ask for: none of those it does may be missing."""
    out = set(CAPITAL.findall(text))
    other = OTHER.search(text)
    if other:
        out.update(w for w in WORD.findall(text) if w[0].isupper())
    if other or CUT.search(text):
        for line in text.split("\n"):
            a = b = 0
            for m in WORD.finditer(line) if other or CUT.search(line) else ():
                # the 40 characters before a name may cut the word before it
                for cut in range(max(a + 1, b - 39), min(b, m.start() - 39)):
                    out.update(WORD.findall(line[cut:b]))
                a, b = m.span()
    if SHOUTED.search(text):
        for line in text.split("\n"):
            for m in ADDRESSES.finditer(line) if SHOUTED.search(line) else ():
                if m[0].isupper():
                    out.update(WORD.findall(m[0]))
    for kind, found in (("i", identities(text)), ("p", phones(text))):
        out.update(kind + "\t" + label(text, at) for at, _, formed in found if not formed)
    return {w.lower() for w in out}


def learn(df: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray, DataFrame | None]:
    """What the whole corpus says about its words: numbers, sorted, and decisions, KEPT at most, and a table of the rest if there is one."""
    prepare(df.sparkSession)

    def count(batches):
        counts = Counts()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    counts.add(t)
            if len(counts.table) > 300_000:
                yield counts.batch()
        yield counts.batch()

    c = F.col
    schema = "word string, " + ", ".join(f"{n} long" for n in COUNTS)
    counted = stored(columns(df, text).mapInArrow(count, schema).groupBy("word").agg(*[F.sum(n).alias(n) for n in COUNTS]), "words")
    often = c("capitals") + c("lower") + c("numbers")
    every, capitals = counted.agg(F.sum(often), F.sum("capitals")).first()
    total = F.greatest(c("capitals") + c("lower"), F.lit(1))
    begins = c("at_start") / F.greatest("capitals", F.lit(1)) > STARTS
    person = (c("company") >= LEAST) & (c("company") / total >= DISCLOSES) & ~begins & (c("lower") / total < 0.75)
    bits = [
        (PERSON, person), (GIVEN, person & (c("first") / F.greatest("in_run", F.lit(1)) > 0.5)), (PROPER, (c("capitals") / total > PROPERLY) & ~begins),
        (RARELY, c("capitals") <= max(3, RARE * (capitals or 0))), (LABELS, c("formed") / F.greatest("numbers", F.lit(1)) >= LABEL),
    ]
    decided = sum((F.when(said, bit).otherwise(0) for bit, said in bits[1:]), F.when(bits[0][1], bits[0][0]).otherwise(0))
    every_word = counted.filter(often > 0).select(F.xxhash64("word").alias("number"), decided.cast("byte").alias("bits"), often.alias("often")).filter(c("bits") != UNKNOWN)
    rare = every // KEPT if every_word.count() > KEPT else 0
    got = every_word.filter(c("often") > rare).select("number", "bits").toArrow()
    rest = stored(every_word.filter(c("often") <= rare).select("number", "bits"), "words") if rare else None
    drop(counted)
    numbers, said = got.column("number").to_numpy(), got.column("bits").to_numpy()
    order = np.argsort(numbers)
    return numbers[order], said[order], rest


def informed(df: DataFrame, key: str, text: str):
    """The decisions that go to all workers, and `key` and `text` of every row; with what each text is lent of the rest, if there is any."""
    numbers, said, rest = learn(df, text)
    shared = df.sparkSession.sparkContext.broadcast((numbers, said))
    if rest is None:
        return shared, columns(df, key, text)

    def ask(batches):
        model = Disclosure(*shared.value)
        cache: dict[str, tuple[int, int]] = {}
        for batch in batches:
            rows, wanted = [], []
            for k, t in enumerate(batch.column(1).to_pylist()):
                for w in asked(t) if t else ():
                    if w not in cache:
                        if len(cache) > 300_000:
                            cache.clear()
                        cache[w] = model.own(w)
                    n, bits = cache[w]
                    if bits < 0:
                        rows.append(k), wanted.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(wanted, pa.int64())], names=["digest", "number"])

    return shared, lent(columns(df, key, text), text, ask, rest, ["number"])


def personal_data(df: DataFrame, key: str = "id", text: str = "texto") -> DataFrame:
    """`key, clase, inicio, fin` of each occurrence, once per key and place, in code points.

    Null and blank texts have none; a text of any length is scanned whole; rows of one key that hold
    the same text count once.
    """
    shared, informed_rows = informed(df, key, text)

    def find(batches):
        model = Disclosure(*shared.value)
        for batch in batches:
            if batch.num_columns > 2:
                model.lend(batch.column(2))
            rows, kinds, start, end = [], [], [], []
            for k, t in enumerate(batch.column(1).to_pylist()):
                for kind, a, b in model.spans(t) if t else ():
                    rows.append(k), kinds.append(kind), start.append(a), end.append(b)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(kinds, pa.string()), pa.array(start, pa.int32()), pa.array(end, pa.int32())], names=[key, "clase", "inicio", "fin"])

    return informed_rows.mapInArrow(find, f"{key} {df.schema[key].dataType.simpleString()}, clase string, inicio int, fin int").distinct()


def sanitised(df: DataFrame, key: str = "id", text: str = "texto") -> DataFrame:
    """Every row's `key` and `texto` with [EMAIL], [TELEFONO], [IDENTIDAD], [DIRECCION] and [NOMBRE] in place of what was found, and `n`, how many; null stays null."""
    shared, informed_rows = informed(df, key, text)

    def clean(batches):
        model = Disclosure(*shared.value)
        for batch in batches:
            if batch.num_columns > 2:
                model.lend(batch.column(2))
            out, number = [], []
            for t in batch.column(1).to_pylist():
                spans = model.spans(t) if t else []
                number.append(len(spans))
                parts, at = [], 0
                for kind, a, b in spans:
                    parts += [t[at:a], f"[{kind.upper()}]"]
                    at = b
                out.append(None if t is None else "".join([*parts, t[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), pa.array(number, pa.int32())], names=[key, text, "n"])

    return informed_rows.mapInArrow(clean, f"{key} {df.schema[key].dataType.simpleString()}, {text} string, n int")
