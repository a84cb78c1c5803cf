import random

import pytest

from panelloom.llm import encoding as E

CLEAN = ["Le propriétaire a augmenté le loyer", "J’habite chez mes parents à côté", "Das Häuschen gehört meiner Großmutter", "Waiting for the bank’s answer — soon", "Снимаем квартиру уже давно", "Não é possível comprar agora", "mañana veré otra habitación", "plain words only"]


def damaged(text, *steps):
    for written, read in steps:
        text = text.encode(written, "replace").decode(read, "replace")
    return text


def test_single_steps_are_undone():
    word = "propriétaire’s"
    for read in ("cp1252", "mac_roman", "cp437", "cp850", "cp1251"):
        seen = damaged(word, ("utf-8", read))
        assert E.undo(seen, read, "utf-8") == word
        assert E.misread_utf8(seen)
    assert E.undo(damaged("Großmutter", ("cp1252", "mac_roman")), "mac_roman", "cp1252") == "Großmutter"
    assert E.undo(damaged("租房", ("gb18030", "cp1252")), "cp1252", "gb18030") == "租房"
    assert E.undo(damaged("can’t", ("utf-8", "gb18030")), "gb18030", "utf-8") == "can’t"
    assert not any(map(E.misread_utf8, ("naïve", "Großmutter", "работой", "½", "«été»", "SÃO", "plain")))


def test_partial_damage_leaves_the_rest():
    assert E.undo_utf8("cÃ´té", "cp1252") == "côté"
    assert E.undo_utf8("côté", "cp1252") is None


@pytest.fixture(scope="module")
def corpus(spark):
    random.seed(1)
    texts = [f"{random.choice(CLEAN)} {random.randint(1, 99)}; {random.choice(CLEAN)}" for _ in range(1500)]
    chains = [(("utf-8", "cp1252"),), (("cp1252", "mac_roman"),), (("utf-8", "cp1251"),), (("cp1251", "cp1252"),), (("utf-8", "cp1252"), ("utf-8", "cp1252"))]
    truth = {}
    rows = []
    for i, t in enumerate(texts):
        seen = t
        if i % 15 == 0:
            try:
                seen = t
                for written, read in chains[i // 15 % len(chains)]:
                    seen = seen.encode(written).decode(read)
            except UnicodeError:
                seen = t
        truth[i] = (t, seen != t)
        rows.append((i, seen, "clash", 0.5))
    rows += [(9001, "lost � here", "x", 0.0), (9002, "", "x", 0.0), (9003, None, "x", 0.0), (9004, "caf&eacute; %C3%A9", "x", 0.0), (9005, "é" * 3000, "x", 0.0), (9006, " ", "x", 0.0)]
    df = spark.createDataFrame(rows, "row_id bigint, txt string, chain string, posterior double")
    return truth, {r["row_id"]: r for r in E.repair(df, key="row_id", text="txt").collect()}


def test_found_and_restored(corpus):
    truth, got = corpus
    wrong = [i for i, (t, bad) in truth.items() if got[i]["damaged"] != bad]
    assert len(wrong) <= 1
    bad = [i for i, (_, b) in truth.items() if b and got[i]["damaged"]]
    assert len(bad) > 50 and sum(got[i]["repaired"] == truth[i][0] for i in bad) >= 0.95 * len(bad)


def test_edge_texts(corpus):
    got = corpus[1]
    assert got[9001]["damaged"] and not got[9001]["restored"]
    assert not got[9004]["damaged"] and not got[9005]["damaged"]
    assert not {9002, 9003, 9006} & set(got)


def test_sources_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "Ã©tÃ©", None), (2, "été", "s"), (3, "été", "s")], "row_id bigint, txt string, src string")
    assert {r["row_id"] for r in E.repair(df, key="row_id", text="txt", source="src").collect()} == {1, 2, 3}
    assert E.repair(df.limit(0), key="row_id", text="txt").count() == 0


HAN = "我们现在和父母一起住在城里，房租每年都在上涨，工资却没有变化。去年换了工作以后想搬到离公司近一点的地方，可是合适的房子很难找。朋友说再等一等，也许明年会便宜一些。孩子上学的事情也要考虑，附近没有好的学校。"


@pytest.mark.parametrize("written, read", [("utf-8", "gb18030"), ("gb18030", "cp1252"), ("utf-8", "cp1251")])
def test_long_texts_without_blanks(spark, written, read):
    rng = random.Random(5)
    clauses = [c for c in HAN.replace("。", "，").split("，") if c]
    clause = lambda: rng.choice(clauses) + rng.choice(["，", "。", f"{rng.randint(1, 9)}，"])

    def misread(text):
        try:
            return text.encode(written).decode(read)
        except UnicodeError:
            return "�"

    seen = {i: "".join(clause() for _ in range(2 if i < 300 else 90)) for i in range(310)}
    truth = {}
    for i in range(1000, 1008):
        text = ""
        for _ in range(5000):
            more = text + "".join(clause() for _ in range(rng.randint(1, 2)))
            if len(text) < 480 + 20 * (i - 1000) and not E._LOST.search(misread(more)):
                text = more
        truth[i], seen[i] = text, misread(text)
    assert all(len(seen[i]) > E.WORD for i in truth)
    got = {r["row_id"]: r for r in E.repair(spark.createDataFrame(list(seen.items()), "row_id bigint, txt string"), key="row_id", text="txt").collect()}
    assert {i for i, r in got.items() if r["damaged"]} == set(truth)
    assert {i for i in truth if got[i]["repaired"] != truth[i]} == set()


def test_one_damaged_word_among_many(spark):
    random.seed(5)
    rows = [(i, f"{random.choice(CLEAN)} {i}; {random.choice(CLEAN)}", None if i % 3 else "a", "q1") for i in range(600)]
    rows += [(1000 + i, damaged(random.choice(CLEAN), ("utf-8", "cp1252")), None, "q2") for i in range(30)]
    whole = "; ".join(["J’habite chez mes parents à côté", "Das Häuschen gehört meiner Großmutter"] * 5)
    rows += [(2000, whole.replace("côté", damaged("côté", ("utf-8", "cp1252")), 1), "a", "q1"), (2001, whole, "a", "q1")]
    df = spark.createDataFrame(rows, "row_id bigint, txt string, feed string, field string")
    got = {r["row_id"]: r for r in E.repair(df, key="row_id", text="txt", source=["feed", "field"]).collect()}
    assert got[2000]["damaged"] and got[2000]["repaired"] == whole and not got[2001]["damaged"]
    assert sum(got[i]["damaged"] for i in range(600)) == 0


def test_shared_buckets_make_no_word_likely():
    counts = E.np.full(E.BUCKETS, 1e6)
    counts[0] = 1e9
    for a, b, c in E.CharModel.slots("zqx"):
        counts[[a, b]] = 0.0, 1e6
    assert E.CharModel(counts).logp("zqx") < E.CharModel(E.np.full(E.BUCKETS, 1e6)).logp("zqx")
