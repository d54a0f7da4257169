"""Problem 3: variant spellings of the names of bodies.

Names are folded to tokens.  Tokens that differ by one edit, or two in long ones, meet in an index of
their neighbourhoods by deletion, so no two tokens are compared that don't share one.  A name is a set of
tokens of three kinds: what kind of body it is, connecting words, and what distinguishes it (its place,
person or subject).  Two names are of one body if an optimal assignment of their tokens, in any order,
pairs all that distinguishes them, equal or a slip apart, where initials, abbreviations and acronyms stand
for whole words.
"""

from __future__ import annotations

import re
import unicodedata
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pliego.llm.spark import columns, prepare, stored

# -- fixed values -------------------------------------------------------------------------------------
#: Words without weight: articles, prepositions, forms of address of a body.
LINKS = {"de", "del", "la", "las", "el", "los", "y", "e", "i", "en", "d", "dels", "les", "a", "do", "da", "dos", "das", "excma", "excmo", "ilma", "ilmo", "ilustre", "excelentisimo", "excelentisima", "rectorado"}
HONOURS = ("excma", "excmo", "ilustre", "excelentisimo", "excelentisima", "rectorado")
#: Words of another language, or short for a first name, for the same word.
SAME = {
    "ajuntament": "ayuntamiento", "concello": "ayuntamiento", "udala": "ayuntamiento", "ayto": "ayuntamiento", "aytmo": "ayuntamiento", "universitat": "universidad", "universidade": "universidad", "fundacio": "fundacion",
    "fdn": "fundacion", "fund": "fundacion", "conselleria": "consejeria", "diputacio": "diputacion", "deputacion": "diputacion", "dip": "diputacion", "mancomunitat": "mancomunidad", "manc": "mancomunidad", "mancom": "mancomunidad",
    "mo": "ministerio", "min": "ministerio", "ap": "autoridad portuaria", "ch": "confederacion hidrografica", "consorci": "consorcio", "puerto": "autoridad portuaria", "port": "autoridad portuaria",
    "pepe": "jose", "paco": "francisco", "lola": "dolores", "nacho": "ignacio", "charo": "rosario", "manolo": "manuel", "concha": "concepcion", "maruja": "maria", "tono": "antonio", "lupe": "guadalupe", "kiko": "francisco", "curro": "francisco",
    "pili": "pilar", "quique": "enrique", "toni": "antonio", "chema": "jose", "maite": "maria", "isa": "isabel", "rafa": "rafael", "santi": "santiago", "javi": "javier", "merche": "merce", "mercedes": "merce",
}

#: Words that a kind of body has anyway, and that may be left out.
IMPLIED = {("mancomunidad", "municipios"), ("diputacion", "provincial"), ("hospital", "comarcal"), ("politecnica", "universidad")}
#: A word in at most so many names may be a slip of one in ESTABLISHED or more; one in more only of a word in OFTEN.
SLIP, ESTABLISHED, OFTEN = 2, 4, 40
#: A word in more than SLIP names may be a slip of one in so many times as many.
TIMES = 8

#: A form meets others by one token if no more names than ALONE have what it stands for, else by two if that makes no more
#: than KEYS keys: this says what the meeting costs, not which forms meet.
ALONE, KEYS = 40, 500

#: Longest acronym, and so most words that one can stand for: it has 2 ** (ACRONYM - 1) keys at most.
ACRONYM = 8

#: Other spellings of a word.
OTHERS: dict[str, list[str]] = {}
for _short, _word in SAME.items():
    OTHERS.setdefault(_word, []).append(_short)

#: Short words for several.
LONGER = [w for w, long in SAME.items() if " " in long]

WORD = re.compile(r"[^\W_]+")


def fold(name: str) -> str:
    text = unicodedata.normalize("NFKD", name.replace("º", "o").replace("ª", "a"))
    return "".join(c for c in text if not unicodedata.combining(c)).lower()


def tokens(name: str) -> list[str]:
    """Folded tokens; letters with full stops between them are one ("A.P." is "ap"), "&" is a link."""
    text = re.sub(r"\b(?:\w\.){2,}", lambda m: m[0].replace(".", "") + " ", fold(name))
    out: list[str] = []
    for w in WORD.findall(text):
        out += SAME.get(w, w).split()
    return out


def content(name: str) -> list[str]:
    """A name's tokens with weight, each once, sorted."""
    return sorted({t for t in tokens(name) if t not in LINKS})


def reach(token: str) -> int:
    """How many edits a token allows."""
    return 0 if len(token) < 4 or not token.isalpha() else 1 if len(token) < 8 else 2


def deletions(token: str, most: int) -> set[str]:
    """The token with up to `most` characters left out."""
    out = level = {token}
    for _ in range(most):
        level = {w[:k] + w[k + 1 :] for w in level for k in range(len(w))}
        out = out | level
    return out


def edits(a: str, b: str) -> int:
    """Insertions, deletions, replacements and swaps of neighbours between two tokens."""
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, before, row = row, row if i == 1 else prev, [i]
        for j, y in enumerate(b, 1):
            n = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                n = min(n, before[j - 2] + 1)
            row.append(n)
        prev = last
    return row[-1]


def shortens(a: str, b: str) -> bool:
    """Whether `a` is an abbreviation of `b`: its letters stand in b in order, the first one first."""
    if not a or len(a) >= len(b) or a[0] != b[0]:
        return False
    at = iter(b)
    return all(c in at for c in a)


def acronym(a: str, words: list[str]) -> bool:
    """Whether `a` is made of the beginnings of the words: of each its first letter and perhaps more of it, in order."""
    if not words:
        return not a
    if not a or a[0] != words[0][0]:
        return False
    return any((n == 1 or shortens(a[:n], words[0])) and acronym(a[n:], words[1:]) for n in range(1, min(4, len(a)) + 1))


def initials(a: str) -> set[str]:
    """What the first letters of the words may be that an acronym stands for: its first letter and any of the rest, in order; two at least."""
    return {a[0] + "".join(c) for n in range(1, len(a)) for c in combinations(a[1:], n)}


def slip(known: int, other: int) -> bool:
    """Whether a word in `known` names is rare enough to be a slip of one in `other`."""
    return known <= SLIP or other >= TIMES * known


def cost(a: str, b: str, known: int, other: int) -> float | None:
    """Of taking token `a`, found in `known` names, for token `b`, found in `other`; None if it can't be."""
    if a == b:
        return 0.0
    if len(a) <= 6 and shortens(a, b) and (len(a) <= 4 or b.startswith(a) or b[: len(a) - 1] == a[:-1]):
        return 0.3 if len(a) == 1 else 0.2
    if slip(known, other):
        for word in (b, *OTHERS.get(b, ())):
            most = max(reach(a), reach(word)) if reach(a) and reach(word) else 0
            if most and abs(len(a) - len(word)) <= most and edits(a, word) <= most:
                return 0.5
        if 4 <= len(a) <= 8 and len(a) < len(b) and a[0] == b[0] and any(edits(a, b[:n]) <= 1 for n in (len(a) - 1, len(a), len(a) + 1)):
            return 0.6
    return None


def weightless(a: str, known: int, honours: dict[str, int]) -> bool:
    """Whether `a` may be a slip of a word without weight, of which `honours` names have each."""
    return any(slip(known, honours.get(w, 0)) and min(reach(a), reach(w)) >= edits(a, w) for w in HONOURS)


def written_out(a: str) -> list[list[str]]:
    """The words that `a` may be a slip for, of those that SAME writes out in several."""
    return [SAME[w].split() for w in LONGER if min(reach(a), reach(w)) >= edits(a, w)]


def short_keys(t: str) -> set[str]:
    """Keys of a token that may stand for another; it shares one with each token it has a cost for."""
    out = {"=" + t, *("=" + word for words in written_out(t) for word in words)}
    if len(t) <= 4:
        out.add("s" + t)
    elif len(t) <= 6:
        out |= {"p" + t, "p" + t[:-1]}
    if reach(t):
        out |= {"d" + d for d in deletions(t, reach(t))}
    if 4 <= len(t) <= 8:
        out |= {"b" + d for d in deletions(t, 1)}
    return out


def full_keys(t: str) -> set[str]:
    """Keys of a token that another may stand for."""
    out = {"=" + t, *("p" + t[:n] for n in (4, 5, 6))}
    out |= {"s" + t[0] + "".join(c) for n in range(4) for c in combinations(t[1:], n)}
    for word in (t, *OTHERS.get(t, ())):
        if reach(word):
            out |= {"d" + d for d in deletions(word, reach(word))}
    if len(t) > 4:
        out |= {"b" + d for n in range(3, min(len(t), 9) + 1) for d in deletions(t[:n], 1)}
    return out


def assign(short: list[tuple[str, int]], full: list[tuple[str, int]], honours: dict[str, int]) -> float | None:
    """Cost of the best assignment of all tokens of `short` to different tokens of `full`; what is left of `full` must be implied,
    or the second surname of a person.  None if there is none."""
    counts = dict(full)
    best: list[float] = []

    def go(k: int, left: frozenset, total: float, solid: int) -> None:
        if best and total >= best[0]:
            return
        if k == len(short):
            rest = [t for t in left if not any((w, t) in IMPLIED for w in counts)]
            if rest and not (len(rest) == 1 and "fundacion" in counts and solid >= 3 and len(counts) == len(short) + 1):
                return
            best[:] = [total + 0.1 * len(left) + 0.5 * len(rest)]
            return
        a, known = short[k]
        if k in idle:
            go(k + 1, left, total + 0.3, solid)
        for long in several.get(k, ()):
            if left.issuperset(long):
                go(k + 1, left.difference(long), total + 0.5, solid)
        for b in left:
            c = cost(a, b, known, counts[b])
            if c is not None:
                go(k + 1, left - {b}, total + c, solid + (c == 0.0 and len(a) > 3))

    # slips of words for several, which may be written out beside them, and of words without weight
    several = {k: [long for long in written_out(a) if all(w in counts and slip(n, counts[w]) for w in long)] for k, (a, n) in enumerate(short)}
    idle = {k for k, (a, n) in enumerate(short) if several[k] or weightless(a, n, honours)}
    if len(short) - len(idle) <= len(full) <= len(short) + 3:
        go(0, frozenset(counts), 0.0, 0)
    return best[0] if best else None


def candidates(ranked: DataFrame, known: DataFrame, honours: dict[str, int]) -> DataFrame:
    """`form, weight, ts, full, fullts, fullweight`: all pairs of forms that `assign` can have a cost for.

    Every token of a form but a slip of a word without weight stands for a token of the other form, and two of them
    for two.  So any token of it, or any two, will do to meet by: its keys are the tokens that the one stands for, or
    the pairs of those of the two.  Those that the fewest names have are taken, two where one alone isn't rare.
    """

    def keyed(make):
        def run(batches):
            for batch in batches:
                t, n, keys = [], [], []
                for token, number in zip(*(c.to_pylist() for c in batch.columns)):
                    for key in make(token):
                        t.append(token), n.append(number), keys.append(key)
                yield pa.RecordBatch.from_arrays([pa.array(t, pa.string()), pa.array(n, pa.int64()), pa.array(keys, pa.string())], names=["t", "n", "key"])

        return known.mapInArrow(run, "t string, n long, key string")

    def stands(batches):
        for batch in batches:
            t, n, c, cn = (x.to_pylist() for x in batch.columns)
            ok = [cost(x, y, k, m) is not None or (slip(k, m) and any(y in long for long in written_out(x))) for x, k, y, m in zip(t, n, c, cn)]
            free = [weightless(x, k, honours) for x, k in zip(t, n)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(free, pa.bool_())], names=["t", "n", "c", "cn", "free"]).filter(pa.array(ok, pa.bool_()))

    a, b = keyed(short_keys).alias("a"), keyed(full_keys).alias("b")
    met = a.join(b, F.col("a.key") == F.col("b.key")).select("a.t", "a.n", F.col("b.t").alias("c"), F.col("b.n").alias("cn")).distinct()
    stand = stored(met.mapInArrow(stands, "t string, n long, c string, cn long, free boolean").groupBy("t").agg(F.sum("cn").alias("mass"), F.count(F.lit(1)).alias("kinds"), F.max("free").alias("free"), F.collect_list("c").alias("cs")), "stand")
    # a form of nothing but possible slips without weight meets by each of them
    chosen = ranked.select("form", "weight", "ts", F.explode(F.col("ts.t")).alias("t")).join(stand.select("t", "mass", "kinds", "free"), "t")
    chosen = stored(chosen.groupBy("form", "weight", "ts").agg(F.array_sort(F.collect_list(F.struct("free", "mass", "t", "kinds"))).alias("by")), "chosen")
    one, two = F.col("by")[0], F.get("by", F.lit(1))
    both = F.coalesce((one["mass"] > ALONE) & ~two["free"] & (one["kinds"] * two["kinds"] <= KEYS), F.lit(False))
    which = F.when(one["free"], F.col("by.t")).when(both, F.array(one["t"], two["t"])).otherwise(F.array(one["t"]))
    picked = chosen.select("form", "weight", "ts", (both & ~one["free"]).alias("both"), which.alias("by"))
    alone = picked.filter("not both").select("form", "weight", "ts", F.explode("by").alias("t")).join(stand.select("t", "cs"), "t").select("form", "weight", "ts", F.explode("cs").alias("key"))
    x, y = stand.select(F.col("t").alias("t0"), F.col("cs").alias("xs")), stand.select(F.col("t").alias("t1"), F.col("cs").alias("ys"))
    paired = picked.filter("both").select("form", "weight", "ts", F.col("by")[0].alias("t0"), F.col("by")[1].alias("t1")).join(x, "t0").join(y, "t1")
    paired = paired.select("form", "weight", "ts", "ys", F.explode("xs").alias("x")).select("form", "weight", "ts", "x", F.explode("ys").alias("y")).filter("x != y")
    short = alone.unionByName(paired.select("form", "weight", "ts", F.concat_ws(" ", F.least("x", "y"), F.greatest("x", "y")).alias("key")))
    pair_keys = F.flatten(F.transform("form", lambda p: F.transform(F.filter("form", lambda q: q > p), lambda q: F.concat_ws(" ", p, q))))
    full = ranked.select(F.col("form").alias("full"), F.col("ts").alias("fullts"), F.col("weight").alias("fullweight"), F.explode(F.concat(pair_keys, F.col("form"))).alias("key"))
    # assign takes no form of more than three tokens more
    fits = (F.col("form") != F.col("full")) & (F.size("full") <= F.size("form") + 3)
    return short.join(full, "key").filter(fits).dropDuplicates(["form", "full"]).select("form", "weight", "ts", "full", "fullts", "fullweight")


def climbed(best: DataFrame) -> DataFrame:
    """`form, root`: where the way from each form to the `full` it leads to, and on from there, ends; for a way that ends in
    a circle the least form of that."""
    steps, before = 1, None
    way = best.select("form", F.col("full").alias("root"), F.least("form", "full").alias("least"))
    while True:
        way = stored(way, "climb")
        going = way.join(best.select(F.col("form").alias("root")), "root", "left_semi").count()
        # as many as at half the steps: all of them lead to circles, whose length is at most their number
        if not going or (going == before and going <= steps):
            break
        on = way.select(F.col("form").alias("root"), F.col("root").alias("next"), F.col("least").alias("further"))
        way = way.join(on, "root", "left").select("form", F.coalesce("next", "root").alias("root"), F.least("least", "further").alias("least"))
        steps, before = 2 * steps, going
    circle = way.select(F.col("form").alias("root"), F.col("least").alias("circle"))
    return way.join(circle, "root", "left").select("form", F.coalesce("circle", "root").alias("root"))


def linked(names: DataFrame, name: str = "nombre") -> DataFrame:
    """`nombre, cuerpo` of every distinct name: names of one body share the value of `cuerpo`, the form of that body.

    Nulls and strings without a letter or digit are no names.  Repeated names count once, so a name that
    stands in a third of all rows is one.  A name that could be of two bodies alike is left to itself.
    """
    spark = names.sparkSession
    prepare(spark)

    def split(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            kept = [[content(n) for n in texts], [sorted(set(tokens(n)).intersection(HONOURS)) for n in texts]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(k, pa.list_(pa.string())) for k in kept)], names=["nombre", "tokens", "honours"])

    times = F.sum("veces") if "veces" in names.columns else F.count(F.lit(1))
    distinct = stored(names.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("nombre")).agg(times.alias("veces")), "distinct")
    made = stored(distinct.select("nombre").mapInArrow(split, "nombre string, tokens array<string>, honours array<string>").filter(F.size("tokens") > 0), "names")

    honours = {r.t: r.n for r in made.select(F.explode("honours").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}

    # slips: a rare token next to an established one is taken for that
    counted = stored(made.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")), "tokens")

    def around(batches):
        for batch in batches:
            t, n, keys = [], [], []
            for token, number in zip(*(c.to_pylist() for c in batch.columns)):
                for d in deletions(token, reach(token)) if reach(token) else ():
                    t.append(token), n.append(number), keys.append(d)
            yield pa.RecordBatch.from_arrays([pa.array(t, pa.string()), pa.array(n, pa.int64()), pa.array(keys, pa.string())], names=["t", "n", "key"])

    index = counted.mapInArrow(around, "t string, n long, key string")
    a, b = index.alias("a"), index.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.t") != F.col("b.t")) & (F.col("a.n") <= F.col("b.n"))).select(F.col("a.t").alias("t"), F.col("a.n").alias("tn"), F.col("b.t").alias("c"), F.col("b.n").alias("n")).distinct()

    def measured(batches):
        for batch in batches:
            t, tn, c, n = (x.to_pylist() for x in batch.columns)
            d = [edits(x, y) for x, y in zip(t, c)]
            ok = [e <= max(reach(x), reach(y)) for e, x, y in zip(d, t, c)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(d, pa.int32())], names=["t", "tn", "c", "n", "d"]).filter(pa.array(ok, pa.bool_()))

    near = stored(met.mapInArrow(measured, "t string, tn long, c string, n long, d int"), "near")
    plain = (F.col("d") == 1) & (((F.col("tn") <= SLIP) & (F.col("n") >= ESTABLISHED)) | ((F.col("n") >= OFTEN) & (F.col("n") >= 8 * F.col("tn"))))
    slips = near.filter(plain).groupBy("t").agg(F.min_by("c", F.struct("d", -F.col("n"), "c")).alias("c"))
    tokened = made.select("nombre", F.explode("tokens").alias("t")).join(slips, "t", "left").select("nombre", F.coalesce("c", "t").alias("t"))
    forms = stored(tokened.groupBy("nombre").agg(F.array_sort(F.collect_set("t")).alias("form")), "forms")

    # forms, how often each is written, and how many names have each of its tokens
    form = forms.join(distinct, "nombre").groupBy("form").agg(F.sum("veces").alias("weight"))
    known = forms.select(F.explode("form").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    spelled = form.select("form", "weight", F.explode("form").alias("t")).join(known, "t")
    ranked = stored(spelled.groupBy("form", "weight").agg(F.array_sort(F.collect_list(F.struct("n", "t"))).alias("ts")), "ranked")

    pairs = candidates(ranked, known, honours)
    # acronyms meet the names whose words begin with letters that stand in them in that order
    order = made.join(forms, "nombre").groupBy("form").agg(F.min("nombre").alias("nombre"))
    single = ranked.filter((F.size("form") == 1) & F.length(F.col("form")[0]).between(3, ACRONYM)).select("form", "weight", "ts", F.col("form")[0].alias("a"))
    several = ranked.filter(F.size("form") >= 3).join(order, "form").select(F.col("form").alias("full"), F.col("weight").alias("fullweight"), "nombre")

    def beginning(batches):
        for batch in batches:
            key = ["".join(w[0] for w in tokens(n) if w not in LINKS) for n in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key, pa.string())], names=["full", "fullweight", "nombre", "key"]).filter(pa.array([len(k) <= ACRONYM for k in key], pa.bool_()))

    def contained(batches):
        for batch in batches:
            kept = [initials(a) for a in batch.column(3).to_pylist()]
            at = pa.array([k for k, keys in enumerate(kept) for _ in keys], pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(at) for c in batch.columns[:3]), pa.array([x for keys in kept for x in keys], pa.string())], names=["form", "weight", "ts", "key"])

    single = single.mapInArrow(contained, "form array<string>, weight long, ts array<struct<n:long,t:string>>, key string")
    several = several.mapInArrow(beginning, "full array<string>, fullweight long, nombre string, key string")

    def judged(batches):
        for batch in batches:
            ts, fullts = batch.column(2).to_pylist(), batch.column(4).to_pylist()
            c = [assign([(x["t"], x["n"]) for x in t], [(x["t"], x["n"]) for x in f], honours) for t, f in zip(ts, fullts)]
            keep = [x is not None for x in c]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), batch.column(5), pa.array(c, pa.float64())], names=["form", "full", "fullweight", "cost"]).filter(pa.array(keep, pa.bool_()))

    def spelled_out(batches):
        for batch in batches:
            forms_, _, ts, full_, fw, names_ = (x.to_pylist() for x in batch.columns)
            c = []
            for f, g, n in zip(forms_, full_, names_):
                words = [w for w in tokens(n) if w not in LINKS]
                c.append(1.0 if acronym(f[0], words) else None)
            keep = [x is not None for x in c]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), batch.column(4), pa.array(c, pa.float64())], names=["form", "full", "fullweight", "cost"]).filter(pa.array(keep, pa.bool_()))

    schema = "form array<string>, full array<string>, fullweight long, cost double"
    direct = pairs.mapInArrow(judged, schema)
    initial = single.join(several, "key").select("form", "weight", "ts", "full", "fullweight", "nombre").mapInArrow(spelled_out, schema)
    weights = ranked.select("form", "weight")
    options = stored(direct.unionByName(initial).join(weights, "form"), "options")
    # of two forms that fit each other the one leads to the other whose words it shortens or misspells, then to the one written more often
    back = options.select(F.col("full").alias("form"), F.col("form").alias("full"), F.struct(F.col("cost"), -F.col("fullweight"), F.col("full")).alias("back"))
    up = options.join(back, ["form", "full"], "left").filter(F.col("back").isNull() | (F.struct(F.col("cost"), -F.col("fullweight"), F.col("full")) < F.col("back")))
    best = stored(up.withColumn("r", F.row_number().over(Window.partitionBy("form").orderBy("cost", F.desc("fullweight"), "full"))).filter("r = 1").select("form", "full"), "best")
    roots = forms.select("nombre", "form").join(climbed(best), "form", "left").select("nombre", F.coalesce("root", "form").alias("form"))
    return roots.select("nombre", F.array_join("form", " ").alias("cuerpo"))


def variant_pairs(names: DataFrame, name: str = "nombre") -> DataFrame:
    """`nombre_a, nombre_b`: pairs of different names of one body, smaller first."""
    made = stored(linked(names, name), "bodies")
    a, b = made.alias("a"), made.alias("b")
    both = a.join(b, (F.col("a.cuerpo") == F.col("b.cuerpo")) & (F.col("a.nombre") < F.col("b.nombre")))
    return both.select(F.col("a.nombre").alias("nombre_a"), F.col("b.nombre").alias("nombre_b"))


def names_of(*fields: tuple[DataFrame, str]) -> DataFrame:
    """`nombre, veces`: the names in several fields, exactly as stored, and how often each stands there."""
    out = None
    for df, field in fields:
        one = columns(df, field).select(F.col(field).alias("nombre")).filter(F.col("nombre").isNotNull()).groupBy("nombre").agg(F.count(F.lit(1)).alias("veces"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("nombre").agg(F.sum("veces").alias("veces"))
