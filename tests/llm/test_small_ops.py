"""Token counts, top-k, mixing, language: against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from odd_tables import no_docs, odd_docs  # noqa: F401

from docloom.llm import arrays
from docloom.llm.language import page_languages
from docloom.llm.mixing import curriculum_mix, curriculum_plan
from docloom.llm.token_counts import Counter, parts, split_long, token_counts
from docloom.llm.topk import nearest_of_table, search_block


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


# --- words -----------------------------------------------------------------


@pytest.mark.parametrize("window", [16, 64, 1 << 18])
def test_words_equal_split(monkeypatch, window):
    r = random.Random(window)
    texts = ["".join(r.choice(["a", "B", " ", "\n", "é", "\x0b", "word", "\x1c"]) for _ in range(r.randrange(40))) for _ in range(300)]
    texts += [None, "", "x" * 1000, "y " * 500]
    monkeypatch.setattr(arrays, "WINDOW", window)
    monkeypatch.setattr(arrays, "_TABLES", {})
    data, offsets = arrays.utf8(pa.array(texts))
    found = arrays.words(data, offsets)
    names = {}
    for i, text in enumerate(texts):
        expected = (text or "").encode().lower().split()
        span = slice(found.offsets[i], found.offsets[i + 1])
        got = [bytes(data[a:b]).lower() for a, b in zip(found.start[span], found.end[span], strict=True)]
        assert got == expected
        for word, value in zip(expected, found.hash[span].tolist(), strict=True):
            assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names)


# --- token counts ----------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("limit", [3, 17, 1000])
def test_split_counts_equal_whole(tokenizer, limit):
    r = random.Random(limit)
    bits = [" ", "  ", "\n", "a", "'s", "'", "1", "<|endoftext|>", "é", "\xa0", "\t", "|", "word", "中", " x", "\x1f", "\x85", "😀"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(50))) for _ in range(3000)]
    counter = Counter(tokenizer)
    for at in range(0, len(texts), 500):
        rows, pieces = [], []
        for i, text in enumerate(texts[at : at + 500]):
            assert "".join(split_long(text, limit)) == text
            for piece in split_long(text, limit):
                head, tail = parts(piece)
                assert "".join([head, *[" " + part for part in tail]]) == piece
                rows.append(i)
                pieces.append(piece)
        counts = np.bincount(rows, counter.count(pieces), minlength=500)
        whole = [len(e) for e in tokenizer.encode_batch(texts[at : at + 500], add_special_tokens=False)]
        assert counts.tolist() == whole


def test_token_counts(spark, tokenizer, odd_docs, no_docs):
    for docs in (table(spark, "documents"), odd_docs):
        rows = docs.select("doc_id", "text").collect()
        got = sorted(map(tuple, token_counts(docs).collect()), key=repr)
        texts = [row["text"] or "" for row in rows]
        counts = [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        expected = [
            (row["doc_id"], len(text.encode()), count, count > 1024)
            for row, text, count in zip(rows, texts, counts, strict=True)
        ]
        assert got == sorted(expected, key=repr)
    assert token_counts(no_docs).count() == 0


# --- top k -----------------------------------------------------------------


@pytest.mark.parametrize("spread", [0, 1, 3, 1000])
def test_block_search_is_exact(spread):
    r = np.random.default_rng(spread)
    x = r.integers(-spread, spread + 1, (500, 6))
    ids = r.permutation(500).astype(np.int64)
    queries, own = x[:40], ids[:40]
    for q, found, scores in search_block(queries, own, x, ids, 5):
        full = x @ queries[q]
        order = [i for i in np.lexsort((ids, -full)) if ids[i] != own[q]][:5]
        assert found.tolist() == ids[order].tolist() and scores.tolist() == full[order].tolist()


def test_top_k_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (50, [1.0, 0.5]), (1, [1.0, nan]), (2, [inf, 0.0]), (3, None), (4, [1.0, None]), (5, [0.5, 0.5])]
    rows += [(5, [0.5, 0.5]), (None, [9.0, 9.0]), (6, [1.0]), (7, [-1.0, 0.001])]
    schema = "vec_id long, embedding array<float>, score int, rank string"
    got = nearest_of_table(spark.createDataFrame([(*row, 1, "x") for row in rows], schema)).collect()
    q = {0: [256, 128], 50: [256, 128], 5: [128, 128], 7: [-256, 0]}
    expected = [
        (a, rank, b, score)
        for a in (0, 50)
        for rank, (score, b) in enumerate(
            sorted(((sum(x * y for x, y in zip(q[a], q[b], strict=True)), b) for b in q if b != a), key=lambda p: (-p[0], p[1])), 1
        )
    ]
    assert sorted(map(tuple, got)) == expected
    assert nearest_of_table(spark.createDataFrame([], schema)).count() == 0


# --- mixing ----------------------------------------------------------------


def shared_out(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing again and again, as exact fractions."""
    from fractions import Fraction

    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, full, left = {}, set(), Fraction(sum(sizes.values()))
    while True:
        open_ = [s for s in names if s not in full]
        if not open_:
            break
        unit = (left - sum(most * sizes[s] for s in full)) / sum(weight[s] for s in open_)
        target |= {s: weight[s] * unit for s in open_}
        above = [s for s in open_ if target[s] > most * sizes[s]]
        if not above:
            break
        full |= set(above)
    return target | {s: Fraction(most * sizes[s]) for s in full}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_targets(spark, seed):
    r = random.Random(seed)
    names = ["a", "b", "é", "Z", None, "aa", "~"][: 3 + seed]
    rows = [(i, "w " * int(r.paretovariate(0.7)), r.choice(names + ["a"] * 8)) for i in range(200)]
    plan = curriculum_plan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    sizes = {}
    for row in plan:
        sizes[row["source"]] = sizes.get(row["source"], 0) + row["size"]
    targets = shared_out(sizes)
    for source, size in sizes.items():
        mine = [row for row in plan if row["source"] == source]
        assert all(abs(row["target"] - float(targets[source])) < 1e-6 for row in mine)
        assert all(row["source_size"] == size and 0 <= row["taken"] <= 3 * row["size"] for row in mine)
        assert sum(row["taken"] for row in mine) == int(mine[0]["target"] + 1e-9)


def test_mix_odd_rows(spark, odd_docs, no_docs):
    plan = curriculum_plan(odd_docs)
    assert plan.count() == odd_docs.count()
    again = curriculum_plan(odd_docs.repartition(3))
    assert sorted(map(repr, plan.collect())) == sorted(map(repr, again.collect()))
    mix = curriculum_mix(odd_docs).collect()
    assert [row["position"] for row in mix] == sorted(row["position"] for row in mix)
    assert sum(row["words"] for row in mix) == sum(row["taken"] for row in plan.collect())
    assert all(row["text"].strip() for row in mix) and set(odd_docs.columns) < set(mix[0].asDict())
    assert curriculum_plan(no_docs).count() == 0 and curriculum_mix(no_docs).count() == 0


@pytest.mark.parametrize("cell_words", [50, 700, 8_000_000])
def test_mix_equals_its_plan_in_cells_of_any_size(spark, cell_words):
    """A source with most rows, repeated ids with equal and other texts, rows
    without an id or source: the copies of the plan, in order, in one shuffle."""
    r = random.Random(cell_words)
    rows = [(i, "w " * int(r.paretovariate(0.8)), r.choice(["a"] * 9 + ["b", "c", None])) for i in range(300)]
    rows += [(5, "again and again", "a")] * 20 + [(6, "v " * i, "a") for i in range(9)] + [(None, "u " * i, "b") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    mix = curriculum_mix(docs, cell_words=cell_words)
    assert mix._jdf.queryExecution().executedPlan().toString().count("Exchange shufflepartitionid") == 1
    got = mix.collect()
    assert [row["position"] for row in got] == sorted(row["position"] for row in got)
    planned = [(c["position"], row["doc_id"] or -1, c["words"]) for row in curriculum_plan(docs).collect() for c in row["copies"]]
    assert sorted((row["position"], row["doc_id"] or -1, row["words"]) for row in got) == sorted(planned)


def test_mix_is_native(spark):
    plan = curriculum_mix(table(spark, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- language --------------------------------------------------------------


def test_page_languages(spark, no_docs):
    docs = table(spark, "documents")
    pages = table(spark, "pages")
    got = page_languages(pages, docs).collect()
    assert len(got) == pages.count()
    agree = [row["lang"] == row["declared"] for row in got if row["declared"] and row["suffix"]]
    assert sum(agree) >= 0.95 * len(agree)
    assert all(0 < row["confidence"] <= 1 + 1e-9 for row in got)
    rows = [(1, None, None), (None, "http://x.de/de/1", ""), (2, "not an address", "<html lang=fr><p"), (2, "http://x.de/de/1", "<script>" * 2000)]
    rows += [(3, "https://Y.example.org/", "<HTML LANG='fr-CA'><body>le la les des une</body>")] * 2
    odd = spark.createDataFrame([(*row, 1, "z") for row in rows], "page_id long, url string, html string, vote int, lang string")
    found = page_languages(odd, docs).collect()
    assert len(found) == len(rows) and all(row["lang"] for row in found)
    assert [row["declared"] for row in found if row["page_id"] == 3] == ["fr", "fr"]
    assert all(row["lang"] is None for row in page_languages(odd, no_docs).collect())
    assert page_languages(odd.limit(0), docs).count() == 0


def test_page_evidence_beats_few_words(spark):
    """A page of two foreign words on a host of one language."""
    docs = spark.createDataFrame([("the house and the river", "en"), ("das haus und der fluss", "de")], "text string, lang string")
    rows = [(i, "http://a.example.de/de/x", "<html lang='de'><p>das haus und der fluss " + "und der fluss " * 20) for i in range(30)]
    rows += [(99, "http://a.example.de/de/y", "<html lang='de'><p>the river")]
    rows += [(100 + i, "http://b.example.uk/en/x", "<html lang='en'><p>the house and the river " * 9) for i in range(30)]
    got = {row["page_id"]: row for row in page_languages(spark.createDataFrame(rows, "page_id long, url string, html string"), docs).collect()}
    assert got[99]["words_lang"] == "en" and got[99]["lang"] == "de" and got[100]["lang"] == "en"
