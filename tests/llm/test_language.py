import random

import numpy as np
import pytest

from panelloom.llm import language as L

TEXTS = {
    "en": ["The first rows are read correctly, but after that nothing arrives any more.", "Nobody on our team knows who wrote this part.", "You have to close the file before you rename it.", "It worked on my machine yesterday.", "I measured it with small files and the difference was hardly visible."],
    "fr": ["Les premières lignes sont bien lues, ensuite plus rien ne se passe.", "Personne dans notre équipe ne sait qui a écrit cette partie.", "Il faut fermer le fichier avant de le renommer.", "Hier cela marchait encore chez moi.", "J’ai mesuré avec de petits fichiers et la différence était à peine visible."],
    "de": ["Die ersten Zeilen werden richtig gelesen, danach kommt nichts mehr an.", "In unserer Gruppe weiß niemand, wer diesen Teil geschrieben hat.", "Man muss die Datei schließen, bevor man sie umbenennt.", "Gestern lief es bei mir noch.", "Ich habe es mit kleinen Dateien gemessen und kaum einen Unterschied gefunden."],
    "zh": ["前面几行都能正常读取，后面就再也没有数据了。", "我们组里没有人知道这一段是谁写的。", "改名之前必须先关闭文件，否则锁不会释放。", "昨天在我的机器上还能运行。", "我用小文件测试过，差别几乎看不出来。"],
}


def test_sentences_leave_out_what_is_no_prose():
    text = "A title\n\nProse here. More `code here` prose!\n```py\nnot this. at all\n```\n    indented code. here\n> Quoted words. <code>x.y</code>\nhttp://host.example/a.b?c see\n```\nunclosed. fence"
    assert [s.replace("\x01", "#") for s in L.sentences(text)] == ["A title", "Prose here.", "More  #  prose!", "Quoted words.", "#  see"]
    assert L.sentences(None) == L.sentences("") == L.sentences("👍 ...") == L.sentences("```\nx") == []
    assert L.sentences("<pre><code>a b. c</code></pre>\n+1") == []


def test_codes(spark):
    labels = {"en": "en", "EN": "en", "eng": "en", " English ": "en", "en_US": "en", "pt-BR": "pt", "zh-Hans": "zh", "ger": "de", "UK": "uk", "Français": "fr", "xx": None, "und": None, "zxx": None, "": None, "??": None, "unknown": None, None: None}
    df = spark.createDataFrame([(k,) for k in labels], "lang string")
    assert [r[0] for r in df.select(L.language_code("lang")).collect()] == list(labels.values())


def test_grams_are_those_of_each_part():
    orders = L.grams(["ab", "", "Ab!"])
    at, where = np.concatenate([a for a, _ in orders]), np.concatenate([w for _, w in orders])
    assert sorted(at[where == 0]) == sorted(at[where == 2]) and not (where == 1).any()
    assert len(at[where == 0]) == 2 + 3 + 2 + 1  # " ab ": letters, pairs, triples, the whole


@pytest.fixture(scope="module")
def corpus():
    random.seed(2)
    docs = []
    for i in range(800):
        lang = random.choices(["en", "fr", "de", "zh"], [5, 2, 2, 1])[0]
        body = " ".join(random.choices(TEXTS[lang], k=4))
        docs.append([i, body, {"en": "en-GB", "fr": "French", "de": "ger", "zh": "zh"}[lang], "a" if i % 3 else None, lang])
    return docs


def test_cases(spark, corpus):
    docs = [list(d) for d in corpus]
    want = set()
    for d in docs[:30]:
        d[2] = random.choice([None, " ", "xx", "??"])
        want.add((d[0], d[4]))
    for d in docs[30:60]:
        d[2] = "fr" if d[4] != "fr" else "en"
        want.add((d[0], d[4]))
    for d in docs[60:90]:
        other = "de" if d[4] != "de" else "en"
        d[1] += "\n\n> " + " ".join(TEXTS[other][:2])
        want |= {(d[0], d[4]), (d[0], other)}
    docs += [[9001, None, None, "a", ""], [9002, "", "en", "a", ""], [9003, "```\nx = 1\n```", None, "a", ""], [9004, "It worked on my machine yesterday. " * 3000, None, None, "en"], [9005, ":-)", "fr", "a", ""]]
    want.add((9004, "en"))
    df = spark.createDataFrame([tuple(d) for d in docs], "doc_id bigint, text string, lang string, source string, code string")
    assert {tuple(r) for r in L.cases(df).collect()} == want
    judged = {r["doc_id"]: r for r in L.judge(df).collect()}
    assert len(judged) == len(docs) and judged[9001]["segments"] == [] and judged[9003]["languages"] == []
    assert all(0 <= x["confidence"] <= 1 for r in judged.values() for x in r["languages"])


def test_held_out_accuracy(corpus):
    train = [(d[4], d[1]) for d in corpus[:400]]
    noisy = [("en" if i % 20 == 0 else c, t) for i, (c, t) in enumerate(train)]
    model = L.Classifier.fit(noisy)
    parts = [d[1] for d in corpus[400:]]
    best = [model.langs[i] for i in model.score(parts).argmax(1)]
    assert sum(b == d[4] for b, d in zip(best, corpus[400:], strict=True)) >= 0.99 * len(parts)


def test_no_labels_and_no_rows(spark):
    df = spark.createDataFrame([(1, "Some words.", None, None)], "doc_id bigint, text string, lang string, source string")
    assert L.judge(df).first()["languages"] == [] and L.cases(df).count() == 0
    assert L.judge(df.limit(0)).count() == 0


def test_languages_of_one_or_two_labels(spark, corpus):
    swedish = ["De första raderna läses rätt, men därefter kommer inget mer fram.", "Ingen i vår grupp vet vem som skrev den här delen.", "Man måste stänga filen innan man byter namn på den."]
    docs = [tuple(d[:4]) for d in corpus]
    docs += [(9001, "Le prime righe vengono lette bene, poi non succede più nulla. Bisogna chiudere il file prima di rinominarlo. Nessuno sa chi ha scritto questa parte.", "it", "a")]
    docs += [(9002, " ".join(swedish), "sv", "a"), (9003, " ".join(swedish[::-1]) + " I går fungerade det hos mig.", "Swedish", None)]
    docs += [(9004, " ".join(TEXTS["en"][:4]), "fi", "a")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string")
    assert [tuple(r) for r in L.cases(df).collect()] == [(9004, "en")]


def test_long_texts_only(spark):
    long = lambda x, i: " ".join(random.Random(i).choices(TEXTS[x], k=2 * L.FIT_CHARS // 20))
    docs = [(i, long(x, i), x, "a") for i, x in enumerate(["en", "fr", "de"] * 3)] + [(90, " ".join(TEXTS["fr"][:3]), None, None)]
    assert all(len(t) > L.FIT_CHARS for _, t, _, _ in docs[:-1])
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string")
    assert [tuple(r) for r in L.cases(df).collect()] == [(90, "fr")]
    empty = spark.createDataFrame([(1, "", "en", "a"), (2, "Some words are here.", None, "a")], "doc_id bigint, text string, lang string, source string")
    assert L.cases(empty).count() == 0


def chain_by_paths(score, prior):
    """The posterior of each sentence's language by all paths through a short document."""
    import itertools
    import math

    n, k = score.shape
    stay, move = math.log(1 - math.exp(L.SWITCH)), L.SWITCH - math.log(k - 1)
    mass = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        p = math.exp(prior[path[0]] + sum(score[i, x] for i, x in enumerate(path)) + sum(stay if a == b else move for a, b in itertools.pairwise(path)))
        for i, x in enumerate(path):
            mass[i, x] += p
    return mass / mass.sum(1, keepdims=True)


def test_chains_equal_the_sum_over_all_paths():
    rng = np.random.default_rng(3)
    lengths = [3, 0, 1, 5, 2, 5]
    score, priors = rng.normal(0, 1.5, (sum(lengths), 3)), np.log(rng.dirichlet([1, 1, 1], len(lengths)))
    score[:3, 0] += 2.0  # all sentences of a document lean to one language
    best, sure = L.chains(score, lengths, priors)
    at = 0
    for n, prior in zip(lengths, priors, strict=True):
        if n:
            want = chain_by_paths(score[at : at + n], prior)
            assert (best[at : at + n] == want.argmax(1)).all() and np.allclose(sure[at : at + n], want.max(1), atol=1e-9)
        at += n
    assert len(L.chains(np.zeros((0, 3)), [0, 0], priors[:2])[0]) == 0


def test_all_links_are_evidence(spark):
    text = "See http://one.example.com/x and https://two.example.fr/y, http://three.fr:80 or http://192.0.2.1/z."
    df = spark.createDataFrame([(1, text, "fr", "a"), (2, "http://a.de", "de", None), (3, "http://b.fr http://c.de", None, "a"), (4, None, None, None)], "doc_id bigint, text string, lang string, source string")
    assert [sorted(r[0]) for r in df.select(L.suffixes(df.text)).collect()] == [["com", "fr"], ["de"], ["de", "fr"], []]
    known, total, table = L.evidence(df)
    assert total == {"fr": 1, "de": 1} and table == {"com": {"fr": 1}, "fr": {"fr": 1}, "de": {"de": 1}}
    assert L._links(["fr", "de", "xyz"], None, table) == {"fr": 1, "de": 1} and L._links([], None, table) is None
    # The way for more suffixes than are broadcast gives the same counts.
    many, _, none = L.evidence(df, most=1)
    assert none == {} and {r["doc_id"]: r["hosts"] for r in many.collect()} == {1: {"fr": 2}, 2: {"de": 1}, 3: {"fr": 1, "de": 1}, 4: None}
