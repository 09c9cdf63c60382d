import zlib

import pytest

from snapledger.llm import language_id as L
from snapledger.llm import queries

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, score string, _found string"


def test_registered_query_is_right_on_held_out_rows(spark):
    got = queries.QUERIES["op7_language_id"](spark, SF).collect()
    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 150
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got} <= {r.lang for r in truth.values()} | {"und"}


def test_edge_cases(spark):
    docs = [(i, ("the cat and the dog " if i % 2 else "der hund und die katze ") * 5, "en" if i % 2 else "de", "x", "y") for i in range(80)]
    docs += [(None, "the", "en", "x", "y"), (900, None, "en", "x", "y"), (901, "", None, "x", "y"), (902, " 12 $% ", "en", "x", "y"),
             (903, "the dog and the cat " * 20_000, None, None, None), (1, docs[1][1], "en", "x", "y")]
    d = spark.createDataFrame(docs, DOCS)
    got = L.predict_languages(d).collect()
    assert len(got) == len(docs)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert [by[i].score for i in (900, 901, 902)] == [0.0] * 3
    assert by[903].lang_pred == "en" and not by[None].held_out
    kept = L.drop_rejected(d)
    assert kept.columns == d.columns
    assert kept.count() == len(docs) - 3


@pytest.mark.parametrize("rows", [[], [(1, "some text", None, "", "")]])
def test_nothing_to_learn(spark, rows):
    d = spark.createDataFrame(rows, DOCS)
    assert [(r.lang_pred, r.score) for r in L.predict_languages(d).collect()] == [("und", 0.0)] * len(rows)
    assert L.drop_rejected(d).count() == len(rows)


def test_prediction_does_not_depend_on_neighbours():
    model = L.fit(["the cat and dog " * 9, "der hund und die katze " * 9] * 20, ["en", "de"] * 20)
    texts = [L.normal(t) for t in ("the dog", "die katze", "x", "cat and hund")]
    best, score = model.predict(texts)
    for i, t in enumerate(texts):
        one = model.predict([t])
        assert (one[0][0], one[1][0]) == (best[i], score[i])


def test_held_out_rows_are_not_learned_from(spark):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    docs = [(i, "abc def ghi", "secret" if i in held else "open", "", "") for i in range(400)]
    got = L.predict_languages(spark.createDataFrame(docs, DOCS)).select("lang_pred").distinct().collect()
    assert [r[0] for r in got] == ["open"]


def test_rare_languages_are_learned(spark):
    """9000 rows of one language, 8 of a rare one with copies and texts without letters, and one of a third."""
    d = spark.range(9000).selectExpr("id as doc_id", "concat('the cat and the dog ', id) as text", "'en' as lang", "'' as score", "'' as _found")
    ids = [i for i in range(10_000, 10_300) if zlib.crc32(str(i).encode()) % 4 != 2]
    rare = [(i, f"der hund und die katze {k}" if k < 8 else "der hund und die katze 0" if k < 100 else "12 ?", "de", "", "") for k, i in enumerate(ids)]
    rare.append((next(i for i in range(20_000, 20_100) if zlib.crc32(str(i).encode()) % 4 != 2), "egy kutya meg egy macska", "hu", "", ""))
    d = d.union(spark.createDataFrame(rare, DOCS))
    got = L.sample(d.where(L.usable()), "doc_id", "text", "lang").collect()
    n = {x: [r["_text"] for r in got if r["_lang"] == x] for x in ("en", "de", "hu")}
    assert len(n["en"]) == L.SAMPLE_ROWS // 3 and len(n["hu"]) == 1
    assert sorted(n["de"]) == [f"der hund und die katze {k}" for k in range(8)]
    assert set(L.train(d.where(L.usable())).labels) == {"en", "de", "hu"}


def test_scores_equal_a_plain_evaluation(monkeypatch):
    """Every subword looked up by itself; texts scored in one piece, in pieces, and in batches."""
    model = L.fit(["the cat and dog " * 9, "der hund und die katze " * 9, "le chat et le chien " * 9] * 20, ["en", "de", "fr"] * 20)
    texts = [L.normal(t) for t in ("the dog", "die Katze ärgert den Hund", "x", "cat et hund " * 40, "é")]

    def plain(text):
        sums = [0.0] * len(model.labels)
        for size, factor in zip(L.GRAMS, L._MIX):
            for i in range(len(text)):
                code = int.from_bytes(text[i : i + size].ljust(size, b"\0"), "little")
                bucket = (code * factor % 2**32) >> 16
                for k, row in enumerate(model.table):
                    sums[k] += float(row[bucket])
        return [s / (len(L.GRAMS) * len(text)) + b for s, b in zip(sums, model.bias)]

    want = [plain(t) for t in texts]
    for size in (L._PIECE, 100, 7):
        monkeypatch.setattr(L, "_PIECE", size)
        assert abs(model.logits(texts) - want).max() < 1e-5


def test_more_labels_than_are_learned(spark, monkeypatch):
    monkeypatch.setattr(L, "LANGUAGES", 2)
    d = spark.range(300).selectExpr(
        "id as doc_id", "concat('words of ', id) as text", "case when id % 3 > 0 then 'en' when id % 2 = 0 then 'de' else concat('x', id) end as lang",
        "'' as score", "'' as _found")
    assert set(L.train(d.where(L.usable())).labels) == {"en", "de"}
