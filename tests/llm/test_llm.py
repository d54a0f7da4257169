"""The operators for training data: against brute force, the libraries, and on edge cases."""

import os
import random
import re
import time
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from pliego.llm import bodies, budget, encode, neardup, overlap, pack, privacy, sentences
from pliego.llm.byte_bpe import ByteBPE
from pliego.llm.viterbi import PieceCounter, from_sentencepiece
from pliego.llm.words import LIKE, WordHash, fold, runs

TOKENIZERS = encode.TOKENIZERS
BPE, PIECES = (os.path.join(TOKENIZERS, n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
DATA = "/root/testdata/sf0.001"
ODD = [" ", "  ", "\n", "\r\n", "\t", "\xa0", "\x85", "\x1c", "'s", "'ll", "a", "é", "12", "½", "中", "ไทย", "!!", "…", "́", "😀", "<|endoftext|>", "　", "ab", "aaaa", "▁", "the", "ing"]


def odd_texts(n, seed=0):
    r = random.Random(seed)
    return ["".join(r.choices(ODD, k=r.randint(0, 40))) for _ in range(n)] + ["", "a" * 3000, "ab" * 900, " " * 700, "ไ" * 500]


def runs_of(text):
    s = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()
    w = re.findall(r"[^\W_]+", s)
    return {tuple(w[k : k + 3]) for k in range(len(w) - 2)}


def like(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# -- tokenizers -----------------------------------------------------------------------------------------


def test_byte_bpe_is_the_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    texts = odd_texts(3000)
    offsets, ids = ByteBPE(BPE).encode([*texts, None])
    want = t.encode_batch(texts, add_special_tokens=False)
    assert all(ids[offsets[k] : offsets[k + 1]].tolist() == want[k].ids for k in range(len(texts)))
    assert offsets[-1] == offsets[-2]
    assert ByteBPE(BPE).counts(texts).tolist() == [len(w.ids) for w in want]


def test_piece_counts_are_the_library():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = odd_texts(3000, 1)
    assert from_sentencepiece(PIECES).counts([*texts, None]).tolist() == [len(x) for x in sp.encode(texts)] + [0]


def test_unigram_paths_against_brute_force():
    r = random.Random(2)
    words = {"▁", *"abcd", *("".join(r.choices("▁abcd", k=r.randint(2, 4))) for _ in range(60))}
    pieces = [(w, -r.random() * 5 - 1) for w in sorted(words)]
    score = dict(pieces)
    low = min(score.values()) - 10

    def best(s):
        top = [(0.0, 0)] + [(-1e18, 0)] * len(s)
        for i in range(len(s)):
            for j in range(i + 1, len(s) + 1):
                g = score.get(s[i:j], low if j == i + 1 else None)
                if g is not None and top[i][0] + g > top[j][0]:
                    top[j] = (top[i][0] + g, top[i][1] + 1)
        return top[-1]

    counter = PieceCounter(pieces, bpe=False, byte_fallback=False)
    texts = ["".join(r.choices("abcdx", k=r.randint(1, 12))) for _ in range(400)]
    assert counter.counts(texts).tolist() == [best("▁" + t)[1] for t in texts]


def test_encode_rows(spark):
    df = spark.createDataFrame([(1, "Hola mundo", "x"), (2, None, "x"), (3, "", "x"), (1, "Hola mundo", "y")], "doc_id long, text string, ids string")
    got = rows(encode.encode_ids(df, BPE), "doc_id", "ids")
    assert got[0] == got[1] and got[2:] == [(2, []), (3, [])] and len(got[0][1]) > 1
    assert encode.encode_ids(df.limit(0), BPE).count() == 0


# -- problem 2 --------------------------------------------------------------------------------------------


def test_budget(spark):
    df = spark.createDataFrame([("a", "hola", "ES-es", 5), ("a", "hola", "es", None), ("b", None, None, -1), ("c", " ", "", 3)], "id string, texto string, lang string, n int")
    c = budget.token_counts(budget.sliced(df, "t", "id", "texto", F.lit("s"), df.lang, F.lit("k"), F.lit(None).cast("string"), df.n), PIECES)
    n = {(r.clave, r.idioma): r.n_tok for r in c.collect()}
    assert n[("b", "und")] == 0 and n[("c", "und")] == 1 and n[("a", "es")] > 0
    total = budget.token_budget(c).filter("nivel = 'fuente'").first()
    assert (total.filas, total.claves, total.con_previo, total.n_previo) == (4, 3, 2, 8) and total.n_tok == 2 * total.n_tok_claves - 1
    assert budget.token_budget(c.limit(0)).count() == 0


# -- problem 7 --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_pack(spark, seed, monkeypatch):
    monkeypatch.setattr(pack, "RANKED", (100_000, 20, 3)[seed])
    r = random.Random(seed)
    sizes = [(k, r.choice([0, 1, 2, 3, 7, 50, 64, 64, 65, 200, r.randint(1, 64)])) for k in range(600)] + [(1000, None), (2000, 7), (2000, 7)]
    got = pack.pack(spark.createDataFrame(sizes, "doc_id long, n_tok int"), 64).collect()
    by_box = {}
    for x in got:
        assert (x.contenedor is None) == (x.n_tok == 0)
        if x.n_tok:
            by_box.setdefault(x.contenedor, []).append((x.inicio, x.n_tok))
    for items in by_box.values():
        items.sort()
        assert items[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(items, items[1:])) and items[-1][0] + items[-1][1] <= 64
    assert sorted(by_box) == list(range(len(by_box)))
    assert sum(x.n_tok for x in got) == sum(n or 0 for _, n in sizes)
    assert all(x.pieza == 0 for x in got if dict(sizes)[x.doc_id] is not None and dict(sizes)[x.doc_id] <= 64)
    assert len(by_box) * 64 - sum(n or 0 for _, n in sizes) < 64 * 3
    empty = pack.pack(spark.createDataFrame([], "doc_id long, n_tok int"), 64)
    assert empty.count() == 0 and pack.waste(empty, 64).first().contenedores == 0


# -- problem 1 --------------------------------------------------------------------------------------------


def edited(text, r, rate):
    return " ".join(w if r.random() > rate else r.choice(["otro", "nuevo", ""]) for w in text.split(" "))


def corpus(seed, n=60, length=120):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    return r, [" ".join(r.choices(vocabulary, k=length)) for _ in range(n)]


def test_overlap_against_brute_force(spark):
    r, texts = corpus(3)
    data = []
    for k, t in enumerate(texts):
        data.append((k, "train", t, f'{{"a": {k}, "b": null}}', "x"))
        data.append((1000 + k, r.choice(["test", "validation"]), edited(t, r, r.choice([0, 0.03, 0.07, 0.5])), f'{{"a": {k if k % 4 else -1}.0}}', "x"))
    data += [(3000, "test", texts[0], None, "x"), (3001, "train", texts[0], "null", "x"), (3002, "test", "dos palabras", "{", "x"), (3003, "train", "dos palabras", "{", "x"), (3004, "test", None, None, "x"), (3005, None, texts[0], '{"a": 1}', "x"), (3006, "train", "Uno dos TRÉS cuatro", None, "x"), (3007, "test", "uno, dos: tres; cuatro", None, "x")]
    df = spark.createDataFrame(data, "row_id long, split string, texto string, json string, same string")
    want = set()
    for a in data:
        for b in data:
            if a[1] == "train" and b[1] in ("test", "validation"):
                text = like(runs_of(a[2] or ""), runs_of(b[2] or "")) >= LIKE
                js = a[3] and b[3] and a[3].startswith('{"a"') and b[3].startswith('{"a"') and float(re.search(r"-?\d+", a[3])[0]) == float(re.search(r"-?\d+", b[3])[0])
                if text or js:
                    want.add((a[0], b[0], bool(text), bool(js)))
    made = overlap.overlap(df, shard_words=1500)
    assert {tuple(x) for x in overlap.pairs(made["rows"], made["links"]).select("train", "eval", "texto", "json").collect()} == want
    cover = {x.row: (x.palabras, x.cubiertas) for x in made["rows"].filter("eval").join(made["coverage"], "same").collect()}
    assert cover[3000] == (120, 120) and all(0 <= c <= p for p, c in cover.values()) and len(cover) == sum(a[1] in ("test", "validation") and len(runs_of(a[2] or "")) > 0 for a in data)
    for e, train in [(a, [b for b in data if b[1] == "train" and b[2]]) for a in data if a[1] == "validation"]:
        found = set().union(*[runs_of(e[2]) & runs_of(b[2]) for b in train if len(runs_of(e[2]) & runs_of(b[2])) >= LIKE * len(runs_of(e[2]))])
        words = e[2].split()
        assert cover[e[0]] == (len(words), len({k + j for k in range(len(words) - 2) if tuple(words[k : k + 3]) in found for j in range(3)}))
    report = overlap.report(df.withColumn("etiqueta", F.lit("e")), **made).collect()
    assert sum(x.pares for x in report) == len(want) and sum(x.solapadas for x in report) == len({e for _, e, _, _ in want})
    assert sum(x.por_texto for x in report) == len({e for _, e, t, _ in want if t}) and sum(x.por_json for x in report) == len({e for _, e, _, j in want if j})
    none = overlap.overlap(df.limit(0))
    assert overlap.pairs(none["rows"], none["links"]).count() == 0 and overlap.report(df.limit(0).withColumn("etiqueta", F.lit("e")), **none).count() == 0


def test_overlap_of_short_texts(spark):
    """Texts of three to twelve words against brute force, and one text inside a longer one."""
    r = random.Random(8)
    texts = [" ".join(r.choices("abcdefgh", k=r.randint(2, 12))) for _ in range(40)]
    texts = [(k, "train", t) for k, t in enumerate(texts)] + [(100 + k, "test", " ".join((t.split() + ["z"])[r.randint(0, 1) :][: r.randint(2, 12)])) for k, t in enumerate(texts)]
    texts += [(901, "train", "alfa beta gamma delta"), (902, "test", "alfa beta gamma delta epsilon"), (903, "train", " ".join(f"v{k}" for k in range(50))), (904, "test", "v7 v8 v9 v10 v11")]
    df = spark.createDataFrame([(*x, None) for x in texts], "row_id long, split string, texto string, json string")
    want = sorted({(a, b) for a, s, x in texts for b, t, y in texts if s == "train" and t == "test" and like(runs_of(x), runs_of(y)) >= LIKE})
    made = overlap.overlap(df, shard_words=60)
    assert len(want) > 10 and rows(overlap.pairs(made["rows"], made["links"]), "train", "eval") == want
    assert made["rows"].filter("row = 904").join(made["coverage"], "same").first().cubiertas == 5


@pytest.mark.parametrize("words", [2, 5, 60])
def test_automaton(words):
    """Against a dictionary: failure links of all depths, ends of texts, texts longer and shorter than a stretch, words that no passage has."""
    r = np.random.default_rng(words)
    letters = overlap.symbols(np.arange(words, dtype=np.uint32))
    known = sorted({tuple(r.choice(letters[: max(2, words // 2)], 3).tolist()) for _ in range(words * words)})
    machine = overlap.Automaton(overlap.passages(np.array(known, np.uint32).ravel())[:: overlap.RUN])
    texts = [r.choice(letters, r.integers(0, 100)).tolist() for _ in range(200)]
    code, want = [], []
    for t in texts:
        want += [(len(code) + k, known.index(tuple(t[k : k + 3]))) for k in range(len(t) - 2) if tuple(t[k : k + 3]) in known]
        code += [*t, overlap.END]
    place, passage = machine.read(np.array(code, np.uint32))
    assert len(want) > 20 and sorted(zip(place.tolist(), passage.tolist())) == want
    assert not len(overlap.Automaton(np.zeros(0, np.uint64)).read(np.array(code, np.uint32))[0])


def test_overlap_scan_is_cheap():
    """Scanning texts costs less than it takes an automaton in C just to read their words, part of which stand in passages."""
    ahocorasick = pytest.importorskip("ahocorasick")
    r = np.random.default_rng(5)
    records = [r.integers(0, 5000, 300, dtype=np.uint32) for _ in range(300)]
    texts = [np.where(r.random(400) < 0.4, r.integers(0, 1 << 32, 400, dtype=np.uint32), np.resize(records[k % 300], 400)) for k in range(500)]
    shard = overlap.Shard(np.arange(300), [overlap.symbols(x).tobytes() for x in records])
    spelled = lambda x: "".join(chr(0x100 + (c >> 11)) + chr(0x800 + (c & 2047)) for c in overlap.symbols(x).tolist())
    machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for x in map(spelled, records):
        for k in range(0, len(x) - 4, 2):
            machine.add_word(x[k : k + 6], k)
    machine.make_automaton()
    text = " ".join(map(spelled, texts))

    def cost(work):
        began = time.process_time()
        work()
        return time.process_time() - began

    assert min(cost(lambda: list(shard.scan(texts))) for _ in range(5)) < min(cost(lambda: list(machine.iter(text))) for _ in range(5))


def test_json_by_value():
    same = [['{"a": 12, "b": [1.50, null]}', '{ "b":[15e-1, null],"a":12.0, "c": null}'], ["1e16", "10000000000000000", "1.0E+16"], ["9007199254740993", "9007199254740993.0"], ["0", "-0.0", "0e9"], ['"\\u00e1"', '"á"'], ["9007199254740992"], ["true"], ["1"], ['"1"'], ["[]"], ["{}"], ["0.1"], ["0.10000000000000001"]]
    keys = [{overlap.canonical(x) for x in group} for group in same]
    assert all(len(k) == 1 and None not in k for k in keys) and len(set().union(*keys)) == len(same)
    assert [overlap.canonical(x) for x in (None, "null", "{", "", "[" * 100_000)] == [None] * 5


# -- problem 4 --------------------------------------------------------------------------------------------


def test_near_duplicates_against_brute_force(spark):
    r, texts = corpus(4, 50)
    data = [(f"a{k}", "T", t, "x") for k, t in enumerate(texts)] + [(f"b{k}", "T", edited(t, r, r.choice([0, 0.02, 0.05, 0.4])), "x") for k, t in enumerate(texts)]
    data += [("c", None, texts[0], "x"), ("c", None, texts[0], "y"), ("d", "", " 　\n", "x"), ("e", None, None, "x"), ("f", None, "uno dos", "x"), ("g", None, "uno dos", "x"), (None, None, texts[0], "x")]
    df = spark.createDataFrame(data, "id string, titulo string, texto string, same string")
    sets = {i: runs_of((t or "") + "\n" + x) for i, t, x, _ in data if i and x and x.strip()}
    want = sorted((a, b) for a in sets for b in sets if a < b and like(sets[a], sets[b]) >= LIKE)
    made = neardup.near_duplicates(df)
    assert rows(made["pairs"], "id_a", "id_b") == want
    assert made["members"].count() == sum(bool(s) for s in sets.values())
    assert neardup.near_duplicates(df.limit(0))["pairs"].count() == 0


def test_words_and_chain(spark):
    h = WordHash()
    for t in ("Año n.º 5½ él", "ﬁn…de", "", "中文 字"):
        w = re.findall(r"[^\W_]+", fold(t))
        assert len(h.numbers(t)) == len(w) and len(runs(h.numbers(t))) == max(0, len(w) - 2)
    got = spark.createDataFrame([(0,), (255,), (-1,), (0x0100000000000001,)], "x long").select(neardup.differing(F.col("x"))).collect()
    assert [r[0] for r in got] == [0, 2, 16, 2]


def test_chain_against_counting(spark):
    """The keys and the chain test on longs say what counting symbols says."""
    r = np.random.default_rng(1)
    a = r.integers(0, 1 << 16, (40, neardup.M)).astype(np.uint16)
    b = np.where(r.random(a.shape) < 0.55, a, r.integers(0, 1 << 16, a.shape).astype(np.uint16))
    (ka, ca), (kb, cb) = neardup.band(a), neardup.band(b)
    data = [(i, j, *ca[i, j].tolist(), *cb[i, j].tolist()) for i in range(40) for j in range(neardup.STARTS) if ka[i, j] == kb[i, j]]
    df = spark.createDataFrame(data, "i int, j int, a0 long, a1 long, b0 long, b1 long")
    got = {(x.i, x.j) for x in df.filter(neardup.chained([df.a0, df.a1], [df.b0, df.b1])).collect()}
    want = set()
    for i in range(40):
        for j in range(neardup.STARTS):
            ring = [(neardup.STEP * j + k) % neardup.M for k in range(neardup.WIDTH * (neardup.CHAIN + 1))]
            low = [(a[i, k] & 15) != (b[i, k] & 15) for k in ring]
            if (a[i, ring[: neardup.WIDTH]] == b[i, ring[: neardup.WIDTH]]).all() and all(sum(low[: neardup.WIDTH * n]) <= n * neardup.TAU / neardup.SEGMENTS for n in range(1, neardup.CHAIN + 2)):
                want.add((i, j))
    assert got == want and 40 < len(want) < len(data)


def test_near_duplicates_of_copies(spark):
    """Copies of two like texts in many tasks are two classes and one link."""
    r, texts = corpus(9, 2)
    one, other = texts[0], texts[0] + " más palabras nuevas al final"
    df = spark.createDataFrame([(f"i{k}", "T", (one, other)[k % 2]) for k in range(60)], "id string, titulo string, texto string").repartition(6)
    made = neardup.near_duplicates(df)
    assert made["links"].count() == 1 and made["members"].select("same").distinct().count() == 2 and made["pairs"].distinct().count() == made["pairs"].count() == 60 * 59 // 2


# -- problem 3 --------------------------------------------------------------------------------------------


def test_bodies(spark):
    groups = [
        ["Ayuntamiento de Duroval de la Zarza", "AYUNTAMIENTO DE DUROVAL DE LA ZARZA", "Ayto. de Duroval de la Zarza", "Ayuntamiento de Duroavl de la Zarza", "Duroval de la Zarza, Ayuntamiento de", "Ajuntament de Duroval de la Zarza "],
        ["Universidad de Duroval de la Zarza", "Univ. de Duroval de la Zarza", "Universitat de Duroval de la Zarza"],
        ["Universidad Politécnica de Duroval de la Zarza", "Univ. Polit. Duroval de la Zarza"],
        ["Ministerio de Puertos y Faros del Litoral", "MPFL", "Min. de Puertos & Faros del Litoral"],
        ["Fundación José Olmedo Ribas (Alba)", "Fund. Pepe Olmedo Ribas (Alba)", "Fundación J. Olmedo Ribas (Alba)", "Fdn. José Olmedo (Alba)", "Olmedo Ribas, José, Fundación (Alba)"],
        ["Ayuntamiento de Otroval de la Zarza"],
    ]
    names = [(n, "x") for g in groups for n in g] + [(None, "x"), ("  ", "x"), (groups[0][0], "y")]
    df = spark.createDataFrame(names, "nombre string, cuerpo string").select("nombre")
    want = sorted(tuple(sorted((a, b))) for g in groups for k, a in enumerate(g) for b in g[k + 1 :])
    assert rows(bodies.variant_pairs(df), "nombre_a", "nombre_b") == want
    assert bodies.variant_pairs(df.limit(0)).count() == 0


def made_up(r, n=10):
    return "".join(r.choice("bdfghjklmnprstvz") + r.choice("aeiou") for _ in range(n // 2))


def test_bodies_hot(spark):
    """Words that more names have than any bound still bring spellings together."""
    r = random.Random(3)
    rest = "Aguas de Pelulleque de Pedratordo"
    group = [f"{k} de {rest}" for k in ("Consorcio", "Cons.", "C.", "Consrocio")]
    names = group + [f"{made_up(r).title()} de {rest}" for _ in range(50)]
    got = rows(bodies.variant_pairs(spark.createDataFrame([(n,) for n in names], "nombre string")), "nombre_a", "nombre_b")
    assert got == sorted(tuple(sorted((a, b))) for k, a in enumerate(group) for b in group[k + 1 :])


def test_bodies_repeated_slips(spark):
    """A slip in more than two names, of a word that SAME replaces too, is one where the right word is far more frequent."""
    r = random.Random(5)
    places = [f"{made_up(r).title()} de {made_up(r).title()}" for _ in range(40)]
    names = {p: [f"Universidad de {p}"] for p in places} | {"puerto " + p: [f"Autoridad Portuaria de {p}"] for p in places}
    for p in places[:4]:
        names[p].append(f"Unoversitat de {p}")
        names["puerto " + p].append(f"Purrto de {p}")
    got = rows(bodies.variant_pairs(spark.createDataFrame([(n,) for g in names.values() for n in g], "nombre string")), "nombre_a", "nombre_b")
    assert got == sorted(tuple(sorted(g)) for g in names.values() if len(g) == 2)


def test_bodies_candidates(spark):
    """No pair of forms that fits is left out, by comparing all."""
    r = random.Random(4)
    words = ["universidad", "univ", "univrsidad", "u", "unoversitat", "politecnica", "pol", "polit", "autoridad", "portuaria", "purrto", "rectoardo", "ap", "diputacion", "dip", "provincial", "mancomunidad", "mnac", "municipios", "lugo", "lgo", "pelulleque", "pelullque", "zarza"]
    forms = {tuple(sorted(r.sample(words, r.randint(1, 5)))) for _ in range(100)}
    short = {"universidad": ["univ", "u", "univrsidad"], "politecnica": ["pol", "polit"], "diputacion": ["dip"], "lugo": ["lgo"], "pelulleque": ["pelullque"], "mancomunidad": ["mnac"]}
    forms = sorted(forms | {tuple(sorted({r.choice(short.get(w, [w])) for w in f})) for f in forms for _ in range(2)})
    count = {w: r.choice([1, 2, 3, 50]) for w in words}
    ranked = spark.createDataFrame([(list(f), 1, sorted((count[t], t) for t in f)) for f in forms], "form array<string>, weight long, ts array<struct<n long, t string>>")
    known = spark.createDataFrame(list(count.items()), "t string, n long")
    met = {(tuple(x.form), tuple(x.full)) for x in bodies.candidates(ranked, known, {"rectorado": 30}).collect()}
    fit = {(f, g) for f in forms for g in forms if f != g and bodies.assign([(t, count[t]) for t in f], [(t, count[t]) for t in g], {"rectorado": 30}) is not None}
    assert len(fit) > 50 and not fit - met


def test_bodies_chain(spark):
    """Forms of one body that lead from one to the next in more than four steps, or in a circle, share its form."""
    words = ["Consorcio", "Aguas", "Pelulleque", "Pedratordo", "Zarzamora", "Duroval", "Montesinos"]
    names = [" ".join([w[:4] + "." for w in words[:k]] + words[k:]) for k in range(7)]
    got = rows(bodies.variant_pairs(spark.createDataFrame([(n,) for n in names], "nombre string")), "nombre_a", "nombre_b")
    assert got == sorted(tuple(sorted((a, b))) for k, a in enumerate(names) for b in names[k + 1 :])
    way = {f"{k:02}": f"{k + 1:02}" for k in range(20)} | {"c": "d", "d": "e", "e": "c", "t": "u", "u": "e"}
    best = spark.createDataFrame([([a], [b]) for a, b in way.items()], "form array<string>, full array<string>")
    assert {r.form[0]: r.root[0] for r in bodies.climbed(best).collect()} == {k: "20" if k < "a" else "c" for k in way}


def test_acronyms_meet():
    """Whatever is an acronym of some words has their first letters among its keys."""
    r = random.Random(7)
    n = 0
    for _ in range(4000):
        words = [made_up(r, r.choice([4, 6])) for _ in range(r.randint(2, 5))]
        a = "".join(w[: r.choice([1, 1, 1, 2, 3])] for w in words)[: bodies.ACRONYM]
        if bodies.acronym(a, words):
            n += 1
            assert "".join(w[0] for w in words) in bodies.initials(a)
    assert n > 1000


def test_edits():
    assert [bodies.edits(a, b) for a, b in (("ab", "ba"), ("abc", "ac"), ("abc", "abc"), ("", "ab"), ("kitten", "sitting"))] == [1, 1, 0, 2, 3]
    assert bodies.deletions("abc", 1) == {"abc", "bc", "ac", "ab"} and bodies.acronym("unisib", ["universidad", "internacional", "sierra", "baja"])


# -- problem 5 --------------------------------------------------------------------------------------------


def people():
    given, sur = ["Marta", "Luis", "Rosa", "Pedro"], ["Zuribia", "Valdoma", "Ortiguel", "Caminreal"]
    r = random.Random(5)
    out = []
    for k in range(80):
        n = f"{r.choice(given)} {r.choice(sur)} {r.choice(sur)}"
        out.append(f"Interesado {n}, con DNI 9{k:07d}M.\nFirmado: {n}.\nEl pleno ve a don {n} hoy.")
    return out


def test_privacy(spark):
    special = "Contacto: Luis Valdoma Ortiguel, tel. (+34) 612 345 678, correo luis (at) correo.example.\nPremio Fundación Rosa Zuribia Ortiguel de obra.\nRegistro 612345678 del libro.\nDomicilio: Calle Roble Alto, n.º 5, 2.º B. 50001 Alba, hoy.\nFirmado: Ortiguel Zuribia, Marta.\nCIF del órgano: G3301779A.\nAsfaltado de la calle Roble Alto y más."
    data = [(str(k), t, "x") for k, t in enumerate(people())] + [("s", special, "x"), ("s", special, "y"), ("n", None, "x"), ("b", "", "x")] + [(f"r{k}", f"Registro {612340000 + k} del libro.", "x") for k in range(30)]
    df = spark.createDataFrame(data, "id string, texto string, clase string")
    got = [(r.clase, special[r.inicio : r.fin]) for r in privacy.personal_data(df).filter("id = 's'").orderBy("inicio").collect()]
    assert got == [("nombre", "Luis Valdoma Ortiguel"), ("telefono", "(+34) 612 345 678"), ("email", "luis (at) correo.example"), ("direccion", "Calle Roble Alto, n.º 5, 2.º B. 50001 Alba"), ("nombre", "Ortiguel Zuribia, Marta")]
    clean = {r.id: (r.texto, r.n) for r in privacy.sanitised(df).collect()}
    assert clean["n"] == (None, 0) and clean["b"] == ("", 0) and "[NOMBRE], con DNI [IDENTIDAD]" in clean["0"][0] and clean["s"][1] == 5
    assert privacy.personal_data(df.limit(0)).count() == 0


def test_privacy_whatever_the_bound(spark, monkeypatch):
    """what is found doesn't depend on how many decisions go to all workers, nor on the size from which they are shared out."""
    data = [(k % 100, t) for k, t in enumerate(people() * 2)] + [(200, None), (201, ""), (202, "Firmado: Rosa Valdoma Caminreal.\nRegistro 612345678 del libro.")] + [(300 + k, f"El pleno se abre hoy {k}, el pleno se cierra.") for k in range(50)]
    df = spark.createDataFrame(data, "digest long, lent string")
    made = []
    for kept in (privacy.KEPT, 20, 2):
        monkeypatch.setattr(privacy, "KEPT", kept)
        made.append((sorted(map(tuple, privacy.personal_data(df, "digest", "lent").collect())), sorted(map(str, privacy.sanitised(df, "digest", "lent").collect()))))
    assert len(made[0][0]) > 300 and (202, "nombre", 9, 31) in made[0][0] and len(made[0][1]) == len(data)
    assert made[1] == made[0] and made[2] == made[0]


def test_privacy_asks_for_all_it_uses():
    """Every decision that a text's spans ask for is among those the text is lent."""
    r = random.Random(8)
    parts = ["Marta", "Ortiguel", "D'Angelo", "RealMadrid", "PREMIO", "J.", "D.", "Ⓐ.", "Ōta", "ΑΘΗΝΑ", "İz", "fooBar", "de la", "Fundación", "CALLE MAYOR ALTA NUEVA LARGA 5", "2ªPLANTAS", "28001 MADRID'S", "DNI", "612345678", "ABC123456", "tel.", "a@b.es", "1234 5678 9012 3456 7890 1234 5678 90", " " * 30, ",", "\n", "«", "x’Y·Z", "X" * 45 + "yZ"]
    used: set[str] = set()

    class Noted(privacy.Disclosure):
        def of(self, word):
            used.add(word.lower())
            return r.choice([privacy.UNKNOWN, privacy.PERSON | privacy.PROPER, privacy.PERSON | privacy.GIVEN, 0])

    model = Noted(np.zeros(0, np.int64), np.zeros(0, np.int8))
    for _ in range(3000):
        text = r.choice(["", " "]).join(r.choices(parts, k=6)) + " " + " ".join(r.choices(parts, k=8))
        used.clear()
        model.spans(text)
        assert used <= privacy.asked(text), (text, used - privacy.asked(text))


# -- problem 8 --------------------------------------------------------------------------------------------


def test_blocks():
    cut = lambda t: [t[a:b] for a, b in sentences.blocks(t)]
    assert cut("a\nb\r\nc") == ["a", "b", "c"] and cut("a\nb\n \nc") == ["a\nb", "c"] and cut("\n\na\nb\n\n") == ["a", "b"] and cut(" \n ") == [] and cut("") in ([], [""])


def test_sentences(spark):
    r = random.Random(6)
    plain = ["Se abre el plazo.", "La obra sigue.", "¿Quién firma?", "El Sr. Alba firma el acta.", "Véase el art. 5 del texto.", "No cabe recurso.", "Dijo: «No. Nunca».", "Mide 3.5 metros."]
    data = [(k, "\n".join(" ".join(r.choices(plain, k=3)) for _ in range(4)), "x") for k in range(200)]
    special = "El Sr. Alba firma el acta. Se abre el plazo.La obra sigue. Dijo: «No. Nunca». ¿Quién firma? Mide 3.5 metros."
    data += [(900, special, "x"), (901, None, "x"), (902, " \n\n ", "x"), (903, "ทุน 5 บาท โรงเรียน\nสะพาน", "x"), (904, "请注意！谁可以？好。", "x"), (905, "TÍTULO I", "x"), (905, "TÍTULO I", "y")]
    df = spark.createDataFrame(data, "doc_id long, text string, inicio string")
    got = {}
    texts = {d: t for d, t, _ in data}
    for x in sentences.sentences(df).orderBy("doc_id", "inicio").collect():
        got.setdefault(x.doc_id, []).append(texts[x.doc_id][x.inicio : x.fin])
    assert got[900] == ["El Sr. Alba firma el acta.", "Se abre el plazo.", "La obra sigue.", "Dijo: «No. Nunca».", "¿Quién firma?", "Mide 3.5 metros."]
    assert 901 not in got and 902 not in got and got[903] == ["ทุน 5 บาท", "โรงเรียน", "สะพาน"] and got[904] == ["请注意！", "谁可以？", "好。"] and got[905] == ["TÍTULO I", "TÍTULO I"]
    want = [s for d in range(200) for s in re.findall("|".join(map(re.escape, plain)), texts[d])]
    made = [s for d in range(200) for s in got[d]]
    assert made == want
    assert sentences.sentences(df.limit(0)).count() == 0


def test_sentences_whatever_the_bound(spark, monkeypatch):
    """the units don't depend on how many words' counts go to all workers, nor on the size from which they are shared out."""
    r = random.Random(9)
    short = ["excma", "ilmos", "sigte", "apart", "númer"]  # as long as the words that end sentences, the names as those that begin them
    plain = ["Se abre el plazo.", "La obra sigue.", "¿Quién firma?", "No cabe recurso."]
    line = lambda: " ".join(r.sample([*r.choices(plain, k=3), f"Véase el {r.choice(short)}. {r.choice(['Li', 'Wu', 'Bo'])} del acta."], 4))
    texts = ["\n".join(line() for _ in range(3)) for _ in range(80)]
    data = [(k % 70, t) for k, t in enumerate([*texts, *texts[:5]])] + [(200, None), (201, " \n\n "), (202, "ทุน 5 บาท โรงเรียน\nสะพาน"), (203, "TÍTULO I"), (203, "TÍTULO I")]
    df = spark.createDataFrame(data, "digest long, lent string")
    made = []
    for kept in (sentences.KEPT, 9, 1):
        monkeypatch.setattr(sentences, "KEPT", kept)
        made.append(sorted(map(tuple, sentences.sentences(df, "digest", "lent").collect())))
    assert len(made[0]) == 85 * 12 + 3 + 2
    assert made[1] == made[0] and made[2] == made[0]


def test_words_have_counts_of_their_own():
    """Counts are by the word, and a word without any takes its class's share."""
    scanner = sentences.Scanner()
    texts = ["Firma el Sr. Alba.\nVéase el núm. 5 del acta.\nEl acta. La obra."] * 30 + ["El acta."] * 60
    rec = np.concatenate([np.array(scanner.scan(t), np.int32).reshape(-1, sentences.FIELDS) for t in texts])
    tables = sentences.Tables(sentences.added([sentences.tally(rec[:200]), sentences.tally(rec[200:])]))
    gap = rec[rec[:, sentences.KIND] == 1]
    assert sorted(set(zip(*(x.tolist() for x in tables.seen(gap, 0))))) == [(30, 0), (30, 90)]
    other = np.array(sentences.record(1, 0, 0, 0, scanner.of("otra"), scanner.of("otra")), np.int32)[None]
    assert tables.seen(other, 0) == (0, 0) and abs(1 / (1 + np.exp(-tables.odds(other, 0)[0])) - min(sentences.MOST, tables.shares[0][other[0, sentences.CLASS[0]]])) < 1e-9


def test_posteriors_against_enumeration():
    rec = np.zeros((4, sentences.FIELDS), np.int32)
    rec[1:, sentences.KIND] = 1
    rec[2, sentences.FLAGS] = sentences.CLOSE
    none = sentences.tally(rec[:0])
    model = sentences.Model(none, none)
    odds = np.array([0.7, -0.4, 0.2])
    model.odds = lambda gap: odds
    total, yes = 0.0, np.zeros(3)
    for bits in range(8):
        e = [(bits >> k) & 1 for k in range(3)]
        w = np.exp(sum(o for o, b in zip(odds, e) if b)) * (model.single if e[0] and e[1] else 1.0)
        total, yes = total + w, yes + w * np.array(e)
    assert model.boundaries(rec)[1:].tolist() == (yes / total >= 0.5).tolist()


# -- queries ----------------------------------------------------------------------------------------------


@pytest.mark.skipif(not os.path.exists(DATA), reason="test tables")
def test_queries_run(spark):
    from pliego.llm.queries import QUERIES

    columns = {"p1_found": ["row_a", "row_b"], "p3_found": ["nombre_a", "nombre_b"], "p4_found": ["id_a", "id_b"], "p5_found": ["id", "clase", "inicio", "fin"], "p6_ids": ["doc_id", "ids"], "p8_found": ["doc_id", "inicio", "fin"]}
    for name, f in QUERIES.items():
        df = f(spark, DATA)
        assert df.count() > 0 and df.columns == columns.get(name, df.columns), name
