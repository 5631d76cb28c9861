"""The learned operators against slow plain-Python versions of their queries."""

import bisect
import math
import string
import zlib

import numpy as np
import pytest

from lexigrid.llm import lang_id, quality, queries

FOLDER = "/root/testdata/sf0.001"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


# -- language identification -------------------------------------------------------


class Slow:
    """Vectors made letter by letter, as lists of numbers."""

    def __init__(self, dim=1024, n=3, seed=11):
        self.dim, self.n, self.seed, self.letters, self.grams = dim, n, seed, {}, {}

    def letter(self, c):
        if c not in self.letters:
            bits = np.random.default_rng([self.seed, ord(c)]).integers(0, 2, self.dim)
            self.letters[c] = [2 * int(b) - 1 for b in bits]
        return self.letters[c]

    def gram(self, g):
        if g not in self.grams:
            out = [1] * self.dim
            for place, c in enumerate(reversed(g)):  # the last letter isn't rotated, the one before it by one place, ...
                letter = self.letter(c)
                out = [x * letter[(i - place) % self.dim] for i, x in enumerate(out)]
            self.grams[g] = np.array(out, float)
        return self.grams[g]

    def vector(self, text):
        spaced = "".join(c if c.isalpha() else " " for c in (text or "").lower())
        if not spaced.strip(" "):
            return None
        shown = " "
        for c in spaced.lstrip(" "):  # of letters' neighbours that are no letters the first one counts
            shown += "" if c == " " and shown[-1] == " " else c
        shown += " "
        return sum(self.gram(shown[i : i + self.n]) for i in range(len(shown) - self.n + 1))


def test_languages_against_vectors_built_letter_by_letter(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang").collect()
    slow, prototypes, vectors = Slow(), {}, {}
    for r in rows:
        vectors[r.doc_id] = v = slow.vector(r.text)
        if v is not None and r.lang is not None and not held(r.doc_id):
            prototypes[r.lang] = prototypes.get(r.lang, 0) + v / np.linalg.norm(v)
    for r in queries.op10_language_id(spark, FOLDER).collect():
        v = vectors[r.doc_id]
        assert r.held_out == held(r.doc_id)
        if v is None:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosines = {k: float(p @ v / np.linalg.norm(p) / np.linalg.norm(v)) for k, p in prototypes.items()}
        best = max(cosines.values())
        assert r.score == pytest.approx(min(1, max(0, best)), abs=1e-4)
        assert cosines[r.lang_pred] == pytest.approx(best, abs=1e-4)


@pytest.mark.parametrize("text", ["a", "A b", "é🙂ß x", "  12 ab--c\n\nd ", "日本語 text", "ab" * 50])
def test_a_text_is_the_sum_of_its_n_grams(text):
    space, slow = lang_id.Space(dim=64, stored=5), Slow(dim=64)
    assert space.vector(text).tolist() == slow.vector(text).tolist()


# -- quality ------------------------------------------------------------------------


def slow_features(text):
    """FEATURES, counted character by character."""
    data = (text or "").encode()
    if not data:
        return [0.0] * len(quality.FEATURES)
    blank, upper, lower, digit = (set(x.encode()) for x in (" \t\n\x0b\x0c\r", string.ascii_uppercase, string.ascii_lowercase, string.digits))
    stop = set(b".,;:?'\"()-")
    marks = {b for b in range(33, 127) if b not in upper | lower | digit | stop}
    words, lines = data.split(), data.split(b"\n")
    n, count, solid = len(data), max(1, len(words)), max(1, sum(b not in blank for b in data))
    share = {k: sum(b in s for b in data) / solid for k, s in (("upper", upper), ("digit", digit), ("stop", stop), ("mark", marks))}
    other = sum(b > 126 or (b < 32 and b not in blank) for b in data) / solid
    return [
        math.log(1 + n), math.log(1 + len(words)), solid / count, len(set(words)) / count,
        max([words.count(w) for w in set(words)], default=0) / count,
        sum(words[i] == words[i + 1] for i in range(len(words) - 1)) / count,
        sum(len(w) <= 3 for w in words) / count, sum(len(w) > 1 and w.isupper() for w in words) / count,
        share["upper"], share["digit"], share["stop"], share["mark"],
        sum(b == ord("|") for b in data) / count, sum(b == ord("!") for b in data) / count, other,
        math.log(1 + len(lines)), 1 - len(set(lines)) / len(lines), math.log(1 + len(words) / len(lines)),
        float(data.rstrip().endswith((b".", b"!", b"?"))),
        sum(w.isascii() and not w.strip(b".,;:?'\"()-").isalpha() for w in words) / count,
    ]


def slow_score(model, x):
    """Bins found and table entries added one by one."""
    total = model.intercept
    for j, value in enumerate(x):
        total += model.tables[j][bisect.bisect_right(model.cuts[j].tolist(), value)]
    for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
        row = bisect.bisect_right(model.pair_cuts[i].tolist(), x[i])
        total += table[row][bisect.bisect_right(model.pair_cuts[j].tolist(), x[j])]
    return 1 / (1 + math.exp(-total))


def test_quality_against_bins_and_additions_row_by_row(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: slow_features(r.text) for r in docs.collect()}
    known = sorted((rows[r.doc_id], float(r.quality)) for r in labels.collect() if r.doc_id in rows and r.quality is not None and not held(r.doc_id))
    x, y = np.array([a for a, _ in known]), np.array([b for _, b in known])
    order = np.lexsort((y, *x.T))
    model = quality.AdditiveModel().fit(x[order], y[order])
    assert model.pairs and any(t.any() for t in model.tables)
    for r in queries.op4_quality(spark, FOLDER).collect():
        wanted = slow_score(model, rows[r.doc_id])
        assert r.score == pytest.approx(wanted, rel=1e-6, abs=1e-9)
        assert (r.held_out, r.predicted) == (held(r.doc_id), int(r.score >= 0.7))


def best_tree(bins, g, h, n_bins, penalty):
    """The three-leaf tree of most gain: the best cut, then the best cut of either side, each tried one by one."""

    def value(part):
        inside = [i for i, b in enumerate(bins) if b in part]
        return sum(g[i] for i in inside), sum(h[i] for i in inside)

    def gain(part):
        a, b = value(part)
        return a * a / (b + penalty)

    def cut(first, end):
        options = [(gain(range(first, c)) + gain(range(c, end)) - gain(range(first, end)), -c) for c in range(first + 1, end)]
        return max(options) if options else (0.0, -first)

    middle = -cut(0, n_bins)[1]
    left, right = cut(0, middle), cut(middle, n_bins)
    edges = sorted({0, middle, n_bins, -(left if left[0] >= right[0] else right)[1]})
    out = [0.0] * n_bins
    for first, end in zip(edges, edges[1:], strict=False):
        a, b = value(range(first, end))
        out[first:end] = [a / (b + penalty)] * (end - first)
    return out


def test_boosting_against_trees_tried_one_by_one():
    draw = np.random.default_rng(5)
    x, y = draw.normal(size=(80, 3)), None
    y = (x[:, 0] + 0.5 * x[:, 1] > 0.2).astype(float)
    model = quality.AdditiveModel(bins=6, pairs=0, rounds=3).fit(x, y)
    logit = [math.log((y.sum() + 0.5) / (81 - y.sum() - 0.5))] * 80
    tables = [[0.0] * (len(c) + 1) for c in model.cuts]
    bins = [[bisect.bisect_right(c.tolist(), v) for v in x[:, j]] for j, c in enumerate(model.cuts)]
    for _ in range(3):
        for j in range(3):
            p = [1 / (1 + math.exp(-t)) for t in logit]
            step = best_tree(bins[j], [a - b for a, b in zip(y, p, strict=True)], [b * (1 - b) for b in p], len(tables[j]), 2.0)
            for b, s in enumerate(step):
                tables[j][b] += 0.15 * s
            logit = [t + 0.15 * step[b] for t, b in zip(logit, bins[j], strict=True)]
    for mine, slow in zip(model.tables, tables, strict=True):
        assert mine.tolist() == pytest.approx(slow, rel=1e-9, abs=1e-12)


def test_conflicting_and_repeated_labels_and_odd_rows(spark):
    good, bad = "A plain sentence of several words. " * 5, "!!! $$$ x9x9 ||| " * 20
    rows = [(i, (good if i % 2 else bad) + str(i), "clash") for i in range(200)] + [(300, "word " * 100_000, "c"), (None, good, "c"), (7, good, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, features string")
    marks = [(i, i % 2) for i in range(200)] * 2 + [(4, 1), (4, 1), (5, None), (None, 1)]
    labels = spark.createDataFrame([(*m, 0.1) for m in marks], "doc_id long, quality int, score double")
    scores = [(r.doc_id, r.score) for r in quality.Quality(docs, labels).scores().collect()]
    assert len(scores) == len(rows) and all(0 <= s <= 1 for _, s in scores)
    assert min(s for i, s in scores if i is not None and i < 200 and i % 2) > max(s for i, s in scores if i is not None and i < 200 and not i % 2)


def test_vectors_are_packed_and_unpacked_in_parts(monkeypatch):
    text = "Of many different words, n-grams repeat: of many, of many."
    whole, slow = lang_id.Space(dim=64).vector(text), Slow(dim=64).vector(text)
    monkeypatch.setattr(lang_id, "TOGETHER", 3)
    space = lang_id.Space(dim=64, stored=20)
    assert (space.vector(text) == whole).all() and (whole == slow).all()
    assert space.grams.itemsize == 1 and space.grams.shape[0] <= 20
