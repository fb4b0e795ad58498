from __future__ import annotations

import random

import corpus_pipeline
from pressroom.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def tables(session, root):
    draw = random.Random(9)
    vocabulary = ["".join(draw.choice("bcdfglmnprst") + draw.choice("aeiou") for _ in range(draw.randrange(1, 5))) for _ in range(900)]
    some = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    item = some(25)
    docs, marks, kinds = [], [], {}
    for i in range(400):
        text = some(draw.randrange(40, 90))
        kind = ["clean", "clean", "clean", "junk", "secret", "leak", "copy"][i % 7]
        if kind == "junk":
            text = [w + "###" for w in text]
        elif kind == "secret":
            text[20] = 'token = "' + "".join(draw.choice("0123456789abcdef") for _ in range(40)) + '"'
        elif kind == "leak":
            text[10:10] = item[3:18]
        elif kind == "copy" and i > 7:
            text = docs[i - 6][1].split() + ["end"]  # the clean document before
        docs.append((i, " ".join(text), "en", f"s{i % 3}", len(" ".join(text))))
        kinds[i] = kind
        marks.append((i, int(kind != "junk"), 0))
    session.createDataFrame(docs, SCHEMA).write.parquet(f"{root}/documents.parquet")
    session.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    session.createDataFrame([(0, " ".join(item))], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return docs, kinds


def test_stages(session, tmp_path):
    docs, kinds = tables(session, tmp_path)
    left = session.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(session, left, str(tmp_path)).write.parquet(f"{tmp_path}/stage{number}")
        left = session.read.parquet(f"{tmp_path}/stage{number}")
        seen.append({r.doc_id for r in left.collect()})
        if number < 4:
            assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert left.count() == len(seen[-1])
    ids = lambda *k: {i for i, x in kinds.items() if x in k}
    assert seen[0] == ids("clean", "secret", "leak", "copy")
    assert seen[1] == seen[0] - {i for i in ids("copy") if i > 7}
    assert seen[2] == seen[1] - ids("leak")
    assert seen[3] == seen[2] and seen[4] < seen[3]
    texts = {r.doc_id: r for r in session.read.parquet(f"{tmp_path}/stage3").collect()}
    for i, text, *_ in docs:
        if i in texts:
            assert ("[assign]" in texts[i].text) == (kinds[i] == "secret") and texts[i].n_chars == len(texts[i].text)
            assert kinds[i] == "secret" or texts[i].text == text
    same = {tuple(r) for r in corpus_pipeline.run(session, str(tmp_path)).collect()}
    assert same == {tuple(r) for r in left.collect()}


def test_odd_rows_through_all_stages(session, odd, tmp_path):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    session.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    session.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(session, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/out{number}")
        docs = session.read.parquet(f"{tmp_path}/out{number}")
        if number == 1:  # the repeated row is gone, the rows without words stay
            assert docs.count() == odd.count() - 1
    empty = docs.limit(0).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(session, empty, str(tmp_path))
        assert empty.count() == 0
        empty = empty.select("doc_id", "text", "lang", "source", "n_chars")


def test_columns_with_the_names_of_helpers_come_back_as_they_were(session, tmp_path):
    names = ["_row", "_text", "_rate", "_Source", "_copies", "row", "host", "rule"]
    docs = [(i, f"some words of text {i} that no other row has {i * 7} at all", "en", f"s{i % 2}", 9, *[f"{n}{i}" for n in names]) for i in range(30)]
    docs = session.createDataFrame(docs, SCHEMA + ", " + ", ".join(f"`{n}` string" for n in names))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    session.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    session.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(session, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/out{number}")
        docs = session.read.parquet(f"{tmp_path}/out{number}")
        assert docs.columns[:13] == ["doc_id", "text", "lang", "source", "n_chars", *names]
        for r in docs.collect():
            assert [r[n] for n in names] == [f"{n}{r.doc_id}" for n in names]
    assert docs.count() > 10


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
