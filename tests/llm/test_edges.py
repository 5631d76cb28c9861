"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import itertools
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from lexigrid.llm import bpe, lang_id, pii, quality, url_rules
from lexigrid.llm.components import components
from lexigrid.llm.decontaminate import Decontamination
from lexigrid.llm.exact_dedup import Dedup
from lexigrid.llm.jaccard_join import JaccardJoin
from lexigrid.llm.line_dedup import LineDedup
from lexigrid.llm.sharding import assign_shards

SCHEMA = "doc_id long, text string, lang string, source string, digest string, row long, node string, score double"
LONG = "lorem ipsum dolor " * 20000


def rows(*texts, first=0):
    return [(first + i, t, "en", "a" if i % 3 else None, "x", 1, "y", 0.5) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    some = rows(None, "", "Same Text", "same text", "SAME TEXT", LONG, LONG.upper(), "É", "é", "\n\n", "a b c")
    some += [(None, "same text", None, None, None, None, None, None), (3, "same text", "en", "b", "x", 1, "y", 0.1)]
    return spark.createDataFrame(some, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs):
    dedup = Dedup(docs)
    found = dedup.decisions().collect()
    assert len(found) == docs.count()
    of = {r.doc_id: (r.keep_id, r.group_size) for r in found}
    assert of[2] == of[3] == of[4] == of[None] == (4, 5)
    assert of[0] == of[1] == (1, 2) and of[5] == (6, 2) and of[7] == (7, 1)
    kept = dedup.kept_rows()
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 6, 7, 8, 9, 10]


def test_exact_dedup_when_digests_collide_and_state_goes_on(spark):
    texts = [f"t{i % 7}" for i in range(40)]
    table = spark.createDataFrame(rows(*texts), SCHEMA).repartition(5)
    found = Dedup(table, digest=lambda t: b"sixteen byte hash" + bytes([len(t)]), files_per_batch=1).decisions().collect()
    for r in found:
        same = [i for i, t in enumerate(texts) if t == texts[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (max(same), len(same), r.doc_id == max(same))


def test_exact_dedup_keeps_one_of_repeated_rows(spark):
    table = spark.createDataFrame(rows("a") * 3, SCHEMA)
    assert Dedup(table).kept_rows().count() == 1


def test_line_dedup(spark, docs):
    line = "  A line of more than Twenty characters\t"
    table = spark.createDataFrame(rows(f"{line}\nx\n{line.lower()}", f"y\n{line}", f"{line}", "short\nshort", None), SCHEMA)
    found = {r.doc_id: r for r in LineDedup(table).summary().collect()}
    kept = {0: "x", 1: "y", 2: line, 3: "short\nshort", 4: ""}
    assert [found[i].n_dropped for i in range(5)] == [2, 1, 0, 0, 0]
    assert [found[i].n_lines for i in range(5)] == [3, 2, 1, 2, 1]
    for i, text in kept.items():
        assert found[i].kept_sha256 == hashlib.sha256(text.encode()).hexdigest()
    cleaned = {r.doc_id: r.text for r in LineDedup(table).cleaned().collect()}
    assert cleaned == kept | {4: None}
    assert LineDedup(docs).summary().count() == docs.count()


@pytest.mark.parametrize("n", [1, 7, 200])
def test_shards(spark, n):
    table = spark.createDataFrame([(i, "t", "hot" if i % 3 else f"s{i % 4}") for i in range(n)], "doc_id long, text string, source string")
    found = assign_shards(table, shards=5, payload=["source"]).toPandas()
    sizes = found.groupby("shard").size().reindex(range(5), fill_value=0)
    assert len(found) == n and sizes.max() - sizes.min() <= 1
    for _, slots in found.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))
    if n == 200:
        hot = found[found.source == "hot"].groupby("shard").size()
        assert hot.max() - hot.min() <= 2


def test_decontamination(spark):
    item = " ".join(f"w{i}" for i in range(12))
    items = spark.createDataFrame([(1, item), (2, "Tiny, item"), (3, None), (4, "?!"), (None, "no name here")], "item_id long, text string")
    texts = ["a " + item.upper() + " b", "w0 w1 w2 w3 w4 w5 w6 w7 w8", "so TINY-item it is", None, "", "no name here", item + " " + item]
    table = spark.createDataFrame(rows(*texts), SCHEMA)
    for most in (1 << 20, 2):  # in one block and in several
        job = Decontamination(table, items, max_windows=most)
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in job.report().collect()}
        assert got == {
            0: (14, 12, ["1"], True), 1: (9, 0, [], False), 2: (5, 2, ["2"], True), 3: (0, 0, [], False),
            4: (0, 0, [], False), 5: (3, 3, [""], True), 6: (24, 24, ["1"], True),
        }
        assert sorted(r.doc_id for r in job.clean_rows().collect()) == [1, 3, 4]
        assert {r.doc_id: r.text for r in job.without_spans().collect()}[2] == "so  it is"


def brute_groups(texts, percent=80):
    def grams(t):
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets, label = [grams(t) for t in texts], list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            a, b = sorted((label[i], label[j]))
            label = [a if x == b else x for x in label]
    return {i: (len(s), x) for i, (s, x) in enumerate(zip(sets, label, strict=True))}


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_against_all_pairs(spark, seed):
    draw = random.Random(seed)
    bases = [[draw.choice("abcdefgh") + str(draw.randrange(30)) for _ in range(draw.choice([3, 60, 150, 900]))] for _ in range(12)]
    texts = [None, "", " \t", "One two", "one TWO"]
    for _ in range(150):
        words = list(draw.choice(bases))
        for _ in range(draw.randrange(0, 6)):
            words[draw.randrange(len(words))] = "new" + str(draw.randrange(99))
        texts.append(" ".join(words))
    table = spark.createDataFrame(rows(*texts), SCHEMA)
    join = JaccardJoin(table, bucket_log=10)
    wanted = brute_groups(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in join.groups().collect()} == wanted
    assert sorted(r.doc_id for r in join.kept_rows().collect()) == sorted(i for i, (_, c) in wanted.items() if i == c)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(30)}


def test_bpe_against_a_library(spark):
    tokenizer = bpe.load_tokenizer(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokenizer.ranks, special_tokens={})
    texts = ["", " " * 500, "x" * 5000, "I'll 'S 've", "日本語🙂🙂 Ⅷ² ١٢٣", "a\x1c\x85 b", LONG[:50000], "<|endoftext|>", "zqxjkvb" * 30]
    slots = [tokenizer.hash.slot(k) for k in tokenizer.ranks]
    assert sorted(slots) == list(range(len(slots)))
    table = spark.createDataFrame(rows(None, *texts), SCHEMA)
    found = {r.doc_id: r for r in bpe.decode(bpe.encode(table, tokenizer), tokenizer).collect()}
    for i, text in enumerate(["", *texts]):
        assert np.frombuffer(found[i].ids, "<u4").tolist() == library.encode_ordinary(text)
        assert found[i].decoded.decode() == text
    for r in bpe.round_trip(table, tokenizer).collect():
        ids = library.encode_ordinary(["", *texts][r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(["", *texts][r.doc_id].encode()).hexdigest()


def test_language_id_on_held_out_rows_and_odd_texts(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    space = lang_id.Space()
    known = lang_id.learn(table, space)
    held = lang_id.identify(table.where(lang_id.held_out(table.doc_id)), space, known)
    right = held.selectExpr("avg(IF(_llm_lang = lang, 1, 0)) AS x").first().x
    assert right >= 0.97
    odd = spark.createDataFrame(rows(None, "", "12 !?", "日本語" * 50, LONG), SCHEMA)
    found = {r.doc_id: (r._llm_lang, r._llm_score) for r in lang_id.identify(odd, space, known).collect()}
    assert found[0] == found[1] == found[2] == ("und", 0.0)
    assert found[3][1] < 0.15 and 0 <= found[4][1] <= 1
    assert all(r._llm_lang == "und" for r in lang_id.identify(odd, space, {}).collect())


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    table, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality.Quality(table, labels).scores().join(labels, "doc_id").where(quality.held_out(labels.doc_id)).toPandas()
    assert ((scored.score >= 0.7) == (scored.quality == 1)).mean() >= 0.97
    odd = spark.createDataFrame(rows(None, "", "\n", LONG), SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.Quality(odd, none).scores().collect()] == [0.5] * 4


def test_personal_data_base_spans(spark):
    def spans(text):
        out = []
        patterns = {
            "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        }
        for kind, pattern in patterns.items():
            for m in re.finditer(pattern, text):
                bare = re.sub("[^0-9]", "", m[0])
                double = sum((2 * int(c) - 9 * (c > "4")) if i % 2 else int(c) for i, c in enumerate(reversed(bare)))
                if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                    continue
                if kind == "card" and not (13 <= len(bare) <= 19 and double % 10 == 0):
                    continue
                if kind == "phone" and not 9 <= len(bare) <= 15:
                    continue
                out.append((kind, m.start(), m.end()))
        return out

    texts = [
        None, "", "é a@b.c_d@e.f. x@y", "1.2.3.4.5.6.7.8 256.1.1.1 007.0.0.0001 1..2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112",
        "+1 (017) 555-7713, +12345 +44.20.7946.0958x", "1 " * 30000, "a" * 60000, "a." * 30000 + "@b", "🙂 q@w.e 🙂 9.9.9.9",
        "x@" + "y." * 20000 + "z", "mail me: joe [at] site [dot] com", "call (212) 555-0199 or 212-555-0199",
    ]
    table = spark.createDataFrame(rows(*texts), SCHEMA)
    for r in pii.PersonalData(table).spans().collect():
        assert [tuple(s) for s in r.base] == spans(texts[r.doc_id] or ""), r.doc_id
        assert set(map(tuple, r.base)) <= set(map(tuple, r.spans))


def test_votes_are_weighed():
    counts = {("phone", "++++"): 40, ("phone", "++00"): 20, ("phone", "--0-"): 60, ("phone", "0+--"): 5}
    belief = pii.reliabilities(counts)["phone"]
    assert belief["++++"] > 0.95 and belief["--0-"] < 0.05 and belief["0+--"] < 0.5


def test_urls(spark):
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/")]
    urls = {
        None: ("", "", None, "allow"), "nothing": ("", "", None, "allow"), "http://A.Example.COM/en/x?y#z": ("a.example.com", "/en/x", "example.com/en/", "block"),
        "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"), "x://com": ("com", "", None, "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"), "http://a.com?b://c/d": ("a.com", "", None, "allow"),
    }
    table = spark.createDataFrame([(i, u, "rule") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    found = {r.url: (r._llm_host, r._llm_path, r._llm_rule) for r in url_rules.judge(table, rules).collect()}
    assert found == {u: x[:3] for u, x in urls.items()}
    many = [(i, f"http://{'bad' if i % 2 else 'good'}.org/p/{i}", None) for i in range(40)] + [(99, "http://bad.net/q", None)]
    marked = [("block", "bad.org", "/"), ("allow", "good.org", "/")]
    table = spark.createDataFrame(many, "page_id long, url string, verdict string")
    assert {r.page_id: r._llm_verdict for r in url_rules.judge(table, marked).collect()}[99] == "block"


def test_empty_tables(spark, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    tokenizer = bpe.load_tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    space = lang_id.Space()
    made = [
        Dedup(empty).decisions(), Dedup(empty).kept_rows(), LineDedup(empty).summary(), assign_shards(empty),
        quality.Quality(empty, spark.createDataFrame([], "doc_id long, quality int")).scores(),
        pii.PersonalData(empty).spans(), Decontamination(empty, none).report(), JaccardJoin(empty).groups(),
        url_rules.judge(spark.createDataFrame([], "page_id long, url string"), [("allow", "com", "/")]),
        bpe.round_trip(empty, tokenizer), lang_id.identify(empty, space, lang_id.learn(empty, space)),
    ]
    assert [m.count() for m in made] == [0] * len(made)
