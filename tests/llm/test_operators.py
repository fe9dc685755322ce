"""Every training-data operator against brute force on small tables with awkward rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from framewell.llm import (
    decontaminate, exact_dedup, jaccard_join, language_id, packing, pii, sentence_spans, sharding, suffix_dedup, warc,
)
from framewell.llm.components import components
from framewell.llm.queries import TEST_KEY, tokenizer_file

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, same string, n int"


def prose(rng, n):
    return " ".join(rng.choice(["ka", "lo", "mi", "ne", "pu"]) + rng.choice(["ra", "to", "zi"]) * rng.randint(1, 3) + rng.choice("abcdefgh") for _ in range(n))


def sentences(rng, n):
    return " ".join(prose(rng, rng.randint(3, 9)).capitalize() + "." for _ in range(n))


def rows():
    rng = random.Random(5)
    base = prose(rng, 120)
    passage = sentences(rng, 14)
    words = base.split()
    edited = [" ".join(w if i % 61 != k else f"new{k}" for i, w in enumerate(words)) for k in range(6)]
    texts = [base, base.replace(" ", "  \t", 3), *edited, None, None, "", " \n", "one", "one two", "One Two", prose(rng, 9000)]
    texts += [sentences(rng, 8) + "\n" + passage + "\n" + sentences(rng, 8) for _ in range(3)]
    texts += ["and " * 300, "éà ç " * 40, "ÉÀ Ç " * 40, "mail ann.b4@mail.example.com or +1 (543) 555-9258, 4349000490986235"]
    texts += [prose(rng, 60) for _ in range(20)]
    out = [(i, t, "xx" if i % 2 else "yy", None if i % 5 == 0 else f"s{i % 3}", 0, "r", "s", 1) for i, t in enumerate(texts)]
    out.append(out[0])  # a repeated row
    out.append((None, base, None, None, 0, "r", "s", 1))  # no id
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def unique(docs):
    return docs.where("doc_id is not null").dropDuplicates(["doc_id"])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def norm(text):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


# -- exact dedup ---------------------------------------------------------------------------
@pytest.mark.parametrize("digest", [exact_dedup.content_hash, lambda t: F.unhex(F.md5(F.length(t).cast("string")))], ids=["md5", "colliding"])
def test_exact_dedup_matches_brute_force_even_when_hashes_collide(docs, digest):
    groups = {}
    for r in rows():
        groups.setdefault(norm(r[1]), []).append(r[0])
    want = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i is not None and i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    got = [tuple(r)[:5] for r in exact_dedup.duplicate_classes(docs, digest=digest).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_deduplicate_keeps_one_whole_row_of_each_text(docs, unique, empty):
    want = len({norm(r[1]) for r in rows()})
    for table in (docs, unique):
        kept = exact_dedup.deduplicate(table)
        assert kept.columns == docs.columns and kept.count() == want
    assert exact_dedup.deduplicate(empty).count() == 0
    assert exact_dedup.duplicate_classes(empty).count() == 0


# -- language identification -----------------------------------------------------------------
def test_language_id_separates_languages_and_rejects_what_is_far(spark, empty):
    rng = random.Random(1)
    def text(s, n): return " ".join("".join(rng.choice(s) for _ in range(rng.randint(2, 4))) for _ in range(n))
    parts = {"aa": ["ka", "lo", "mi"], "bb": ["ße", "üt", "dö"]}
    data = [(i, text(parts[k], 5 + i % 90), k, None, 0, "r", "s", 1) for i, k in enumerate(["aa", "bb"] * 60)]
    train = spark.createDataFrame(data, SCHEMA)
    model = language_id.fit(train, per_language=40)
    tests = [(1000 + i, text(parts[k], 8 + i), k, None, 0, "r", "s", 1) for i, k in enumerate(["aa", "bb"] * 20)]
    odd = [(1, None, None, None, 0, "r", "s", 1), (2, "12 34 !", None, None, 0, "r", "s", 1), (3, "漢字仮名交文例題 " * 30, None, None, 0, "r", "s", 1), (4, "", None, None, 0, "r", "s", 1)]
    table = spark.createDataFrame(tests + odd, SCHEMA)
    got = {r["doc_id"]: r for r in language_id.predict(table, model).collect()}
    assert all(got[t[0]]["lang_pred"] == t[2] and not got[t[0]]["rejected"] for t in tests)
    assert all((got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True) for i in (1, 2, 4))
    assert got[3]["rejected"]
    kept = language_id.keep_known(table, model)
    assert kept.columns == table.columns and {r[0] for r in kept.collect()} == {t[0] for t in tests}
    assert kept.where("doc_id = 1005").first()["text"] == tests[5][1]
    nothing = language_id.fit(empty)
    assert {r["lang_pred"] for r in language_id.predict(table, nothing).collect()} == {"und"}
    assert language_id.predict(empty, model).count() == 0


def test_other_latin_languages_and_random_letters_are_rejected(spark):
    rng = random.Random(7)

    def made(n, common, rare):
        words = [rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice(rare) for _ in range(rng.randint(1, 3))) for _ in range(n)]
        return " ".join(words)

    known = {"en": (["the", "of", "and", "in"], ["tion", "ing", "er", "sh", "ble", "ou", "wh"]), "es": (["de", "la", "que", "los"], ["ción", "mente", "ar", "ñ", "ado", "ll"])}
    data = [(i, made(30 + 7 * (i % 60), *known[k]), k) for i, k in enumerate(["en", "es"] * 240)]
    odd = ["абвгдежзик", "αβγδεζηθικ", "漢字仮名交文例題日本"]  # three wrongly labelled texts of each language
    data += [(1000 + i, " ".join("".join(rng.choice(odd[i // 2]) for _ in range(5)) for _ in range(200)), "en" if i % 2 else "es") for i in range(6)]
    model = language_id.fit(spark.createDataFrame(data, "doc_id bigint, text string, lang string"), clusters=1)
    stay = [(i, made(25 + i, *known[k]), k) for i, k in enumerate(["en", "es"] * 40)]
    far = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
        " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(150)),
    ]
    table = spark.createDataFrame([s[:2] for s in stay] + [(100 + i, t) for i, t in enumerate(far)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in language_id.predict(table, model).collect()}
    assert all(got[i]["lang_pred"] == k and not got[i]["rejected"] for i, _, k in stay)
    assert all(got[100 + i]["rejected"] for i in range(len(far)))


def test_limits_are_low_but_not_set_by_one_odd_text():
    many = {10: [0.8] * 99 + [0.1], 12: [0.9] * 3}
    limits = language_id.band_limits(many, 0.02, 0.4)
    assert limits[10] == pytest.approx(0.32) and limits[8] == 0 and limits[12] == pytest.approx(0.32)
    assert language_id.band_limits({10: [0.2] * 5 + [0.8] * 95}, 0.02, 0.4)[10] == pytest.approx(0.2)
    assert not language_id.band_limits({}, 0.02, 0.4).any()


def test_held_out_is_the_crc_of_the_id(spark):
    got = spark.range(50).select("id", language_id.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in got)


# -- personal data ------------------------------------------------------------------------------
def test_pseudonyms_keep_formats_are_linked_and_can_be_undone():
    rng = random.Random(3)
    cards = []
    for _ in range(50):
        body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        cards.append(body + pii.check_digit(body))
    values = [("card", c) for c in cards] + [("date", "2021-03-04"), ("date", "3/14/1999"), ("date", "25.12.1980"), ("ip", "67.190.110.215"),
              ("phone", "+1 (543) 555-9258"), ("phone", "+44 20 7946 0958"), ("ssn", "123-45-6789"), ("email", "hnp.46@mail3.example.com")]
    seen = set()
    for kind, value in values:
        new = pii.pseudonym(kind, value, TEST_KEY)
        assert new != value and len(new) == len(value)
        assert [c.isdigit() for c in new] == [c.isdigit() for c in value]
        assert pii.pseudonym(kind, new, TEST_KEY, back=True) == value
        assert new == pii.pseudonym(kind, value, TEST_KEY) and new != pii.pseudonym(kind, value, b"another key of 16")
        seen.add((kind, new))
    assert len(seen) == len(values)
    for kind, value in [("card", "4349000490986230"), ("date", "2021-02-30"), ("ip", "300.1.1.1"), ("ssn", "000-12-3456"), ("phone", "+1 (043) 555-9258")]:
        assert pii.pseudonym(kind, value, TEST_KEY) is None


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_permutation_is_one_to_one(size):
    image = [pii.permuted(i, size, TEST_KEY, "t") for i in range(size)]
    assert sorted(image) == list(range(size))
    assert [pii.permuted(i, size, TEST_KEY, "t", back=True) for i in image] == list(range(size))


def test_pseudonymise_replaces_only_what_is_valid(docs, empty):
    got = {r["doc_id"]: r for r in pii.pseudonymise(docs, TEST_KEY).collect()}
    mail = next(r for r in rows() if r[1] and "@" in r[1])
    new = got[mail[0]]
    kinds = [f["kind"] for f in new["found"]]
    assert kinds[:2] == ["email", "phone"] and "ann.b4" not in new["text"] and "543" not in new["text"]
    assert len(new["text"]) == len(mail[1])
    assert all(got[r[0]]["text"] == r[1] and got[r[0]]["n_found"] == 0 for r in rows() if r[0] != mail[0])
    assert pii.pseudonymise(empty, TEST_KEY).count() == 0


# -- sentence spans ----------------------------------------------------------------------------
def brute_spans(table, k=3, least=24):
    """Removed pieces of each (id, text), by comparing all spans of all documents."""
    first, per = {}, {}
    for doc, text in sorted(set(table), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        pieces = sentence_spans.pieces_of(text or "")
        spans = []
        for a in range(len(pieces)):
            for b in range(a + k - 1, len(pieces)):
                size = sum(p[2] for p in pieces[a : b + 1])
                shortest = lambda x, y: y - x + 1 == k or sum(p[2] for p in pieces[x : y + 1]) < least
                if size >= least and (shortest(a, b - 1) or shortest(a + 1, b) or b - a + 1 == k):
                    spans.append((a, b, tuple(p[3] for p in pieces[a : b + 1])))
        per[doc, text] = spans
        for a, b, s in spans:
            first.setdefault(s, (doc, a))
    gone = {}
    for (doc, text), spans in per.items():
        gone[doc, text] = {i for a, b, s in spans if first[s] != (doc, a) for i in range(a, b + 1)}
    return gone


def test_sentence_spans_remove_all_but_the_first_occurrence(docs, empty):
    want = brute_spans([(r[0], r[1]) for r in rows()])
    got = sentence_spans.remove_repeated(docs).collect()
    assert len(got) == len(rows())
    by_id = {d: (len(g), t) for (d, t), g in want.items()}
    assert all(r["n_removed"] == by_id[r["doc_id"]][0] for r in got)
    assert sum(r["n_removed"] > 0 for r in got) >= 4  # two further passages, the copies and the repeated word
    untouched = {r["doc_id"]: r["text"] for r in got if not r["n_removed"]}
    assert all(text == by_id[d][1] for d, text in untouched.items())
    assert sentence_spans.remove_repeated(empty).count() == 0


@pytest.mark.parametrize("blank", [" ", ""], ids=["words", "signs"])
def test_sentence_spans_find_passages_inside_long_sentences(spark, blank):
    rng = random.Random(11)

    def unit():
        return chr(rng.randint(0x4E00, 0x9FA5)) if not blank else prose(rng, 1)

    passage = [unit() for _ in range(60)]
    before = {i: [unit() for _ in range(i)] for i in range(17)}
    texts = [[*before[i], *passage, *(unit() for _ in range(20))] for i in range(17)]
    texts.append([*before[5], *passage[:30], unit(), *passage[30:]])  # one inserted
    table = spark.createDataFrame([(i, blank.join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in sentence_spans.remove_repeated(table).collect()}
    assert got[0]["text"] == blank.join(texts[0])
    for i in range(1, 17):  # by words: a run of the passage is gone, and nothing else
        left = got[i]["text"].split() if blank else list(got[i]["text"])
        gone = len(texts[i]) - len(left)
        assert 60 - 2 * 12 <= gone <= 60
        assert any(left == [*texts[i][:k], *texts[i][k + gone :]] for k in range(i, i + 60 - gone + 1))
    assert got[17]["n_removed"] > 0


def test_sentence_ends_of_other_scripts():
    text = "今日は晴れです。明日も晴れ！また来週？" + "ab cd. ef"
    assert [text[a:b] for a, b, *_ in sentence_spans.pieces_of(text)] == ["今日は晴れです。", "明日も晴れ！", "また来週？", "ab cd. ", "ef"]
    assert [p[2] for p in sentence_spans.pieces_of("漢字 かな abc def")] == [6]


# -- suffix arrays -------------------------------------------------------------------------------
def test_suffix_dedup_finds_every_long_repeat_and_nothing_else(docs, empty):
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeated(docs).collect()}
    table = sorted({(r[0], r[1]) for r in rows()}, key=lambda r: (r[0] is None, r[0] or 0))
    seen = {}
    for doc, text in table:
        words = (text or "").encode().lower().split()
        covered = set()
        for i in range(len(words) - 49):
            key = tuple(words[i : i + 50])
            if key in seen:
                covered.update(range(i, i + 50))
            seen.setdefault(key, (doc, i))
        removed = {i for r in got[doc]["removed"] for i in range(r["from"], r["to"])}
        assert removed == covered, doc
        assert got[doc]["n_words"] == len(words) and got[doc]["n_removed"] == len(removed)
        left = [w for i, w in enumerate((text or "").split()) if i not in removed]
        assert (got[doc]["text"] or "").split() == left and (got[doc]["text"] is None) == (text is None)
    assert suffix_dedup.remove_repeated(empty).count() == 0


def test_suffix_matches_survive_any_partitioning(docs, spark):
    touched = lambda: sorted(repr(r[0]) for r in suffix_dedup.remove_repeated(docs).where("n_removed > 0").collect())
    plain = touched()
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert plain and touched() == plain
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_suffix_matches_reach_as_far_as_any_earlier_place(spark, docs):
    rng = random.Random(13)
    core, out = prose(rng, 40).split(), []
    left, right = prose(rng, 24).split(), prose(rng, 24).split()
    for i in range(90):  # one passage in very many surroundings, which agree with others over different lengths
        a, b = rng.randint(0, 24), rng.randint(0, 24)
        mine = [*(f"l{i}x{k}" for k in range(30)), *left[24 - a :], *core, *right[:b], *(f"r{i}\u00a0{k}" for k in range(30))]
        out.append((None if i == 40 else i, " ".join(mine)))
    table = spark.createDataFrame([*out, out[3]], "doc_id bigint, text string").repartition(5)
    seen, want = {}, {}
    for doc, text in sorted(out, key=lambda r: (r[0] is None, r[0] or 0)):
        words = text.encode().split()
        runs = [tuple(words[i : i + 50]) for i in range(len(words) - 49)]
        want[doc] = len({i + k for i, run in enumerate(runs) if run in seen for k in range(50)})
        seen.update((run, doc) for run in runs)
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeated(table).collect()}
    assert got == want and sum(map(bool, want.values())) > 40


def test_nothing_goes_that_repeats_from_no_single_place(spark):
    """Two passages below 50 words that overlap in a third document, and a seed between two different neighbours."""
    rng, out = random.Random(17), []
    for k in range(25):
        whole = prose(rng, 80).split()
        a, b = whole[:45], whole[32:]
        out += [(100 * k, [*prose(rng, 30).split(), *a, *prose(rng, 30).split()]), (100 * k + 1, [*prose(rng, 30).split(), *b, *prose(rng, 30).split()])]
        out.append((100 * k + 2, [*prose(rng, 30).split(), *whole, *prose(rng, 30).split()]))
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in out], "doc_id bigint, text string").repartition(4)
    assert {r["n_removed"] for r in suffix_dedup.remove_repeated(table).collect()} == {0}


# -- Jaccard join --------------------------------------------------------------------------------
def brute_components(table):
    sets = []
    for doc, text in table:
        w = (text or "").encode().lower().split()
        sets.append((doc, {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()))
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, s) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, (d, s) in enumerate(sets)), key=repr)


def test_jaccard_components_match_all_pairs(docs, empty):
    want = brute_components([(r[0], r[1]) for r in rows()])
    assert sorted((tuple(r) for r in jaccard_join.jaccard_classes(docs).collect()), key=repr) == want
    assert jaccard_join.jaccard_classes(empty).count() == 0


def test_jaccard_components_of_chains_and_crowds(spark):
    rng = random.Random(9)
    data, words = [], prose(rng, 60).split()
    for i in range(120):  # drifting copies, and many of one base whose copies differ more from each other
        if i % 2:
            words[rng.randrange(60)] = f"w{i}"
            text = words
        else:
            text = [f"x{i}" if k in (i % 60, (i * 7) % 60) else w for k, w in enumerate(prose(random.Random(2), 90).split())]
        data.append((i, " ".join(text)))
    data += [(1000 + i, " ".join(prose(rng, rng.randint(1, 7)).split())) for i in range(30)]
    table = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
    assert sorted((tuple(r) for r in jaccard_join.jaccard_classes(table).collect()), key=repr) == brute_components(data)


def test_representatives_find_every_link(spark, monkeypatch):
    """No rounds of hubs: all links come from representatives by hash."""
    monkeypatch.setattr(jaccard_join, "HUB_ROUNDS", 0)
    rng = random.Random(21)
    base, data = prose(rng, 100).split(), []
    families = [[(rng.randrange(90), f"f{f}v{v}") for v in range(3)] for f in range(12)]
    for i in range(140):  # members share a family's changes and have some of their own: replaced, dropped and added words
        words = list(base)
        for at, word in families[i % 12]:
            words[at] = word
        for _ in range(rng.randrange(3)):
            at, how = rng.randrange(80), rng.randrange(3)
            words[at : at + (how != 2)] = [] if how == 1 else [f"own{i}"]
        data.append((i, " ".join(words + ["tail"] * (i % 5 == 0))))
    want = brute_components(data)
    assert 3 < len({r[2] for r in want}) < 140
    table = spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)
    assert sorted((tuple(r) for r in jaccard_join.jaccard_classes(table).collect()), key=repr) == want


def test_components_of_paths_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[i] == 100 for i in range(100, 160)) and got[202] == 200


# -- decontamination --------------------------------------------------------------------------------
def test_decontamination_matches_brute_force(spark, docs, empty):
    import re

    long = next(r[1] for r in rows() if r[1] and len(r[1].split()) > 1000).split()
    base = rows()[0][1].split()
    items = [("a", " ".join(base[5:40])), ("b", " ".join(long[100:118]).upper()), ("c", "one, two"), ("d", None), ("e", "..."), ("f", " ".join(base[100:109] + ["never"])),
             ("a", " ".join(base[60:71])), ("g", "and " * 12), ("h", "éà ç éà ç éà ç éà ç éà ç")]
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id string, text string, doc_id string")

    def cut(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))

    want = []
    for r in rows():
        words, hit, ids = cut(r[1]), set(), set()
        for item, text in items:
            w = cut(text)
            n = min(10, len(w))
            for k in range(len(w) - n + 1 if w else 0):
                for p in range(len(words) - n + 1):
                    if words[p : p + n] == w[k : k + n]:
                        hit.update(range(p, p + n))
                        ids.add(item)
        want.append((r[0], len(words), len(hit), sorted(ids)))
    found = decontaminate.decontaminate(docs, table)
    got = [(r["doc_id"], r["n_words"], len(r["hits"]), r["item_ids"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert all(r["near_items"] >= len(set(r["item_ids"])) for r in found.collect())
    clean = decontaminate.clean_documents(docs, table)
    assert clean.columns == docs.columns
    assert sorted((r[0] for r in clean.collect()), key=repr) == sorted((w[0] for w in want if not w[2]), key=repr)
    assert decontaminate.decontaminate(empty, table).count() == 0
    assert {len(r["hits"]) for r in decontaminate.decontaminate(docs, table.limit(0)).collect()} == {0}


def test_proximity_tolerates_inserted_words(spark):
    item = [f"w{i}" for i in range(10)]
    texts = [(1, " ".join(item)), (2, " ".join([*item[:5], "and", *item[5:]])), (3, " ".join(item[::-1])), (4, "nothing")]
    table = spark.createDataFrame(texts, "doc_id bigint, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    got = {r["doc_id"]: (len(r["hits"]), r["near_items"]) for r in decontaminate.decontaminate(table, items, picks=10).collect()}
    assert got[1] == (10, 1) and got[2] == (0, 1) and got[4] == (0, 0)


# -- WARC ------------------------------------------------------------------------------------------
def test_archives_round_trip_through_the_index(spark, tmp_path):
    big = "x" * 1500 + "\r\n\r\nWARC/1.1 é"
    pages = [(1, "http://m.a.example.net/en/25?q=1#top", big), (2, "HTTPS://A.example.net:80/z", big), (3, None, None), (4, "http://a.b/c d\r\nX: y", "short"),
             (5, "http://a.b/2", "short"), (9, "http://b/", big), (6, "", ""), (7, "http://b/", "other " * 300), (7, "http://b/", "other " * 300)]
    table = spark.createDataFrame([(*p, "x") for p in pages], "page_id bigint, url string, html string, digest string")
    folder = str(tmp_path / "archives")
    warc.write_archives(table, folder)
    records = warc.read_archives(spark, folder)
    index = warc.build_index(records, block=3)
    keys = table.select(warc.url_key(warc.encoded(F.col("url"))).alias("key"))
    got = warc.fetch(warc.lookup(index, keys)).collect()
    want = []
    for p, _, html in pages:
        data = (html or "").encode()
        same = max(q[0] for q in pages if (q[2] or "") == (html or "")) if len(data) >= 1000 else p
        want.append((p, len(data), hashlib.sha1(data).hexdigest(), "response" if same == p else "revisit", None if same == p else same))
    assert sorted(((r["record_id"], r["payload_bytes"], r["payload_digest"], r["kind"], r["refers_to"]) for r in got), key=repr) == sorted(want, key=repr)
    some = spark.createDataFrame([("b)/",), ("nowhere)/",)], "key string")
    assert sorted(r["record_id"] for r in warc.fetch(warc.lookup(index, some)).collect()) == [7, 7, 9]
    starts = {}
    for r in index.collect():
        assert r["first_key"] <= r["last_key"] and r["captures"] <= 3
        starts.setdefault(r["shard"], []).append(r["first_key"])
    warc.write_archives(table.limit(0), str(tmp_path / "none"))
    nothing = warc.read_archives(spark, str(tmp_path / "none"))
    assert warc.fetch(warc.lookup(warc.build_index(nothing), keys)).count() == 0


def test_wide_directories_are_searched_by_shard(spark, tmp_path, monkeypatch):
    table = spark.createDataFrame([(i, f"http://h{i % 7}.x/{i}", f"{i}") for i in range(60)], "page_id bigint, url string, html string")
    warc.write_archives(table, str(tmp_path / "a"))
    index = warc.build_index(warc.read_archives(spark, str(tmp_path / "a")), block=4)
    monkeypatch.setattr(warc, "DIRECTORY_BYTES", -1)
    keys = table.select(warc.url_key("url").alias("key")).where(F.col("key").startswith("x,h3"))
    assert sorted(r["record_id"] for r in warc.fetch(warc.lookup(index, keys)).collect()) == list(range(3, 60, 7))


def test_url_keys(spark):
    urls = ["http://m.Ththth.example.net/en/25#top", "//u:p@a.b:8080?x=/y", "plain.org/p", "http://a.b"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(warc.url_key("u")).collect()]
    assert got == ["net,example,ththth,m)/en/25", "b,a)/?x=/y", "org,plain)/p", "b,a)/"]


# -- packing ---------------------------------------------------------------------------------------
@pytest.mark.parametrize("shares", [None, {"s1": 3.0, "s2": 1.0}])
def test_packing_loses_no_token_and_leaves_no_gap(docs, empty, shares):
    import struct

    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_file())
    pieces = packing.pack(docs, tokenizer_file(), length=64, chunk=16, window=256, shares=shares).collect()
    fills = {}
    for p in pieces:
        fills.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert sorted(fills) == list(range(len(fills)))
    for s, parts in fills.items():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at and size > 0
            at += size
        assert at == 64 or s == len(fills) - 1
    for r in rows():
        ids = [*tok.encode(r[1] or "", add_special_tokens=False).ids, 2]
        mine = [p for p in pieces if p["doc_id"] == r[0]]
        copies = sum(x[0] == r[0] for x in rows())
        assert sum(p["length"] for p in mine) == len(ids) * copies
        for p in mine:
            assert p["doc_tokens"] == len(ids) and p["source"] == r[3]
            assert list(struct.unpack(f"<{p['length']}I", p["ids"])) == ids[p["start"] : p["start"] + p["length"]]
    assert packing.pack(empty, tokenizer_file()).count() == 0


def test_windows_hold_the_target_mixture(spark):
    rng = random.Random(4)
    data = [(i, prose(rng, rng.randint(5, 60)), "big" if i % 3 else "small") for i in range(300)]
    table = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    tokens = packing.token_table(table, tokenizer_file(), 2)
    served = packing.serve(tokens.select("row", "doc_id", "source", "n"), window=2000, chunk=32).collect()
    totals = {}
    for r in served:
        totals[r["source"]] = totals.get(r["source"], 0) + r["size"]
    whole = sum(totals.values())
    for source in totals:
        for turn in range(max(r["round"] for r in served)):
            sent = sum(r["size"] for r in served if r["source"] == source and r["round"] <= turn)
            assert abs(sent - (turn + 1) * 2000 * totals[source] / whole) <= 32  # the deficit never exceeds a chunk


# -- sharding --------------------------------------------------------------------------------------
def test_lookup_table_is_even_and_stable(spark, docs, empty):
    names = [f"n{i}" for i in range(7)]
    table = sharding.lookup_table(names, 1009)
    sizes = [int((table == i).sum()) for i in range(7)]
    assert max(sizes) - min(sizes) <= 1
    fewer = sharding.lookup_table(names[:-1], 1009)
    kept = [a == b for a, b in zip(table, fewer, strict=True) if a != 6]
    assert sum(kept) / len(kept) > 0.7
    placed = sharding.place(docs.withColumn("slot", F.lit("x")), F.col("doc_id"), names, slots=1009).collect()
    for r in placed:
        text = "" if r["doc_id"] is None else str(r["doc_id"])
        slot = int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % 1009
        assert (r["slot"], r["shard"], r["shard_name"]) == (slot, table[slot], names[table[slot]])
    assert len(placed) == len(rows()) and sharding.place(empty, F.col("doc_id"), names).count() == 0
    wide = sharding.place(spark.range(400).withColumn("k", F.lit("hot")), F.col("k"), names, spread=50, within=F.col("id"))
    assert wide.select("shard").distinct().count() == 7 or wide.select("slot").distinct().count() > 40
    for bad in ({"slots": 1000}, {"shards": ["a", "a"]}, {"shards": []}):
        with pytest.raises(ValueError):
            sharding.lookup_table(**{"shards": names, "slots": 1009} | bad)
