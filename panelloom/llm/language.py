"""Languages of documents and of their parts.

The prose of a text (without code, program output, links, names in code marks and signs) is cut into sentences. Each
sentence gets a posterior over languages: the likelihood of its hashed character n-grams, fused with a prior for the
document from its declared label, the suffixes of all addresses in its links, and its source's habits, which are
smoothed towards those of all sources. A chain over a document's sentences keeps single doubtful ones with their
neighbours; runs of one language are the document's segments.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import UNICODE_SPACE, strip
from panelloom.plans.parallel import spread
from panelloom.plans.skew import checked_lookup

# Language codes with their three-letter codes and names, as public standards give them.
LANGUAGES = """
en eng english | fr fra fre french français francais | de deu ger german deutsch | es spa spanish castilian español espanol
it ita italian italiano | pt por portuguese português portugues | nl nld dut dutch nederlands flemish | sv swe swedish svenska
da dan danish dansk | nb nob bokmål | no nor norwegian norsk | nn nno nynorsk | fi fin finnish suomi | is isl ice icelandic
pl pol polish polski | cs ces cze czech čeština | sk slk slo slovak | sl slv slovenian slovene | hr hrv croatian | sr srp serbian
bs bos bosnian | bg bul bulgarian | mk mkd mac macedonian | ru rus russian русский | uk ukr ukrainian українська | be bel belarusian
lt lit lithuanian | lv lav latvian | et est estonian | hu hun hungarian magyar | ro ron rum romanian română | el ell gre greek
tr tur turkish türkçe | az aze azerbaijani | kk kaz kazakh | ka kat geo georgian | hy hye arm armenian | he heb hebrew
ar ara arabic | fa fas per persian farsi | ur urd urdu | hi hin hindi | bn ben bengali | ta tam tamil | te tel telugu
th tha thai | vi vie vietnamese | id ind indonesian | ms msa may malay | tl tgl tagalog | zh zho chi chinese mandarin 中文 | ja jpn japanese 日本語
ko kor korean 한국어 | ca cat catalan | gl glg galician | eu eus baq basque | ga gle irish | cy cym wel welsh | sq sqi alb albanian
af afr afrikaans | sw swa swahili | la lat latin | eo epo esperanto
"""
_CODE = {name: words[0] for part in LANGUAGES.replace("\n", "|").split("|") if (words := part.split()) for name in words}

#: Buckets of the n-gram table, orders of n-grams, and parts of the log-likelihood counted (n-grams overlap).
BUCKETS, ORDERS, TEMPER = 1 << 17, (1, 2, 3, 4), 0.35
#: The classifier is fitted on at most this many labelled documents a language; where texts of at most FIT_CHARS are too
#: few, on the first sentences of longer ones too, as many as have that many characters.
FIT_DOCUMENTS, FIT_CHARS, FIT_ROUNDS = 400, 20_000, 2
FIT_BLOCK = 50
#: Documents that a worker judges at once.
BATCH = 500
#: The label of a document whose language has fewer labelled ones is tried against a model without the document.
LEAST_DOCUMENTS = 3
#: Records by which a source's habits are smoothed towards those of all sources.
SMOOTH = 20.0
#: Logarithm of the chance that the next sentence is in another language; least confidence of a language; least words.
SWITCH, SURE, WORDS = math.log(0.01), 0.8, 3

_CUT = [
    (re.compile(r"(?ms)^[ \t]*(```|~~~).*?(?:^[ \t]*\1[^\n]*$|\Z)"), "\n\n"),
    (re.compile(r"(?is)<pre\b.*?(?:</pre>|\Z)"), "\n\n"),
    (re.compile(r"(?is)<code\b.*?(?:</code>|\Z)"), " \u0001 "),
    (re.compile(r"(?is)<(script|style)\b.*?(?:</\1>|\Z)"), "\n\n"),
    (re.compile(r"`[^`\n]*`"), " \u0001 "),
    (re.compile(r"(?m)^(?: {4,}|\t)[^\n]*$"), "\n"),
    (re.compile(r"(?i)\b(?:https?|ftp)://[^\s<>\"')\]]+|\bwww\.[^\s<>\"')\]]+|\b[\w.+-]+@[\w-]+\.[\w.]+"), " \u0001 "),
    (re.compile(r"<[^<>\n]{1,200}>"), " "),
    (re.compile(r"&[#\w]{1,10};"), " "),
    (re.compile(r"(?<![\w/])[\w-]+(?:[./\\][\w-]+)+(?!\w)"), " \u0001 "),  # file names, paths, versions, numbers
    (re.compile(r"\S*[_=(){}\[\]<>|$#~^\\]\S*"), " \u0001 "),
]
_QUOTE = re.compile(r"(?m)^(?:[ \t]{0,3}>[ ]?)+")
_SENTENCE = re.compile(r"(?<=[.!?…])[\"'”’»)]*\s+|(?<=[。！？])|\n+")
_WORD = re.compile(r"[^\W\d_]+(?:[’'-][^\W\d_]+)*")
_FULL = re.compile(r"[.!?…。！？:：][\"'”’»)\s]*$")
_HAN = re.compile(r"[぀-ヿ㐀-鿿가-힯]")
_HOST = r"(?i)https?://(?:[^/\s:@]+@)?([^/\s:?#<>\"']+)"


def language_code(c: Column | str) -> Column:
    """The two-letter code that a label names, whatever its spelling; null if it names none."""
    s = F.lower(strip(F.col(c) if isinstance(c, str) else c, UNICODE_SPACE))
    table = F.create_map(*[F.lit(x) for kv in sorted(_CODE.items()) for x in kv])
    return F.coalesce(F.try_element_at(table, s), F.try_element_at(table, F.regexp_extract(s, r"^([a-z]{2,3})(?:[-_@. (].*)?$", 1)))


def sentences(text: str | None) -> list[str]:
    """The sentences of a text's prose; a title or list item without a stop is one too."""
    if not text:
        return []
    s = _QUOTE.sub("", text.replace("\r\n", "\n").replace("\r", "\n"))
    for pattern, by in _CUT:
        s = pattern.sub(by, s)
    return [x for x in (p.strip() for p in _SENTENCE.split(s) if p) if x and _WORD.search(x)]


def _units(sentence: str) -> int:
    """Words of a sentence; two ideographs count as one."""
    han = len(_HAN.findall(sentence))
    return han // 2 + len(_WORD.findall(_HAN.sub(" ", sentence)))


def grams(parts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, part index) of the n-grams of each order; other characters than letters are one blank between words.

    Part indices ascend within an order.
    """
    joined = "\n".join(f" {words} " if (words := re.sub(r"[\W\d_]+", " ", p.lower()).strip()) else "" for p in parts)
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    part = np.cumsum(codes == 10)
    inside = codes != 10
    out = []
    # Of each end position: the hash of the n-gram that ends there, and whether it lies within one part.
    h, whole = codes.copy(), inside.copy()
    for n in range(1, max(ORDERS) + 1):
        if n > 1:
            h, whole = h[:-1] * np.uint64(1000003) + codes[n - 1 :], whole[:-1] & inside[n - 1 :]
        if n in ORDERS and len(h):
            keep = whole & ((codes[n - 1 :] != 32) | (n > 1))
            mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            out.append((((mixed >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int32)[keep], part[n - 1 :][keep].astype(np.int32)))
    return out


def _sums(table: np.ndarray, orders: list[tuple[np.ndarray, np.ndarray]], parts: int) -> np.ndarray:
    """Rows of the table summed by part."""
    score = np.zeros((parts, table.shape[1]))
    for at, where in orders:
        if len(at):
            starts = np.flatnonzero(np.diff(where, prepend=-1))
            score[where[starts]] += np.add.reduceat(table[at], starts, axis=0)
    return score


class Classifier:
    """Log-likelihoods of hashed n-grams per language, float32 of fixed size."""

    def __init__(self, langs: list[str], table: np.ndarray):
        self.langs, self.table = langs, table

    @classmethod
    def fit(cls, labelled: list[tuple[str, str]], rounds: int = FIT_ROUNDS) -> Classifier:
        """From (language, text); wrong labels are corrected by what the other texts say, round by round.

        A language that no text is left of isn't known.
        """
        langs = sorted({x for x, _ in labelled})
        own = np.array([langs.index(x) for x, _ in labelled], dtype=np.int64)
        # The n-grams lie in compact blocks, and only a block's worth of them is expanded at a time.
        blocks = []
        for i in range(0, len(labelled), FIT_BLOCK):
            blocks.append((i, grams([". ".join(sentences(t)) for _, t in labelled[i : i + FIT_BLOCK]])))
        few = np.bincount(own, minlength=len(langs)) < LEAST_DOCUMENTS
        first = own.copy()
        for _ in range(rounds + 1):
            counts = np.zeros(len(langs) * BUCKETS)
            for i, at, where in ((i, *pair) for i, orders in blocks for pair in orders):
                counts += np.bincount(own[i + where].astype(np.int64) * BUCKETS + at, minlength=len(counts))
            counts = counts.reshape(len(langs), BUCKETS)
            shared = counts.sum(0) / max(1.0, counts.sum())
            total = counts.sum(1, keepdims=True)
            table = np.log((counts + 200.0 * shared + 1e-3) / (total + 200.0 + 1e-3 * BUCKETS)).T.astype(np.float32).copy()
            for i, orders in blocks:
                score = _sums(table, orders, min(FIT_BLOCK, len(labelled) - i))
                part = own[i : i + FIT_BLOCK]
                some = score.any(1)
                score[:, few] = -np.inf
                for k in np.flatnonzero(few[first[i : i + FIT_BLOCK]]):
                    # A lone text always fits the model made of it: what it says itself is taken off. Other models of
                    # few texts are mostly smoothing and take whatever is new, so texts only go to a language of many.
                    mine, at = first[i + k], np.concatenate([a[w == k] for a, w in orders])
                    rest = counts[mine] - (np.bincount(at, minlength=BUCKETS) if part[k] == mine else 0)
                    score[k, mine] = np.log((rest[at] + 200.0 * shared[at] + 1e-3) / (rest.sum() + 200.0 + 1e-3 * BUCKETS)).sum()
                own[i : i + FIT_BLOCK] = np.where(some, score.argmax(1), part)
        left = np.flatnonzero(counts.sum(1) > 0)
        if 0 < len(left) < len(langs):
            return cls([langs[x] for x in left], table[:, left].copy())
        return cls(langs, table)

    def score(self, parts: list[str]) -> np.ndarray:
        """Tempered log-likelihoods, one row per part."""
        if not parts:
            return np.zeros((0, len(self.langs)))
        return _sums(self.table, grams(parts), len(parts)) * TEMPER


def chains(score: np.ndarray, lengths: Sequence[int], priors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language, confidence) of each sentence by the forward-backward posterior of its document.

    score: a row per sentence, the documents' sentences one after the other; lengths: sentences of each document;
    priors: a row per document. A step runs over all documents that are long enough for it.
    """
    n, k = score.shape
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    e = score - score.max(1, keepdims=True)
    stay, move = 1.0 - math.exp(SWITCH), math.exp(SWITCH) / max(1, k - 1)

    def step(x: np.ndarray) -> np.ndarray:
        top = x.max(1, keepdims=True)
        w = np.exp(x - top)
        return top + np.log(w * (stay - move) + w.sum(1, keepdims=True) * move)

    size = np.asarray(lengths, dtype=np.int64)
    begin = np.cumsum(size) - size
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    # How many documents have more than t sentences.
    alive = [int(np.searchsorted(-size, -t, side="left")) for t in range(int(size[0]))]
    forward, backward = np.empty((n, k)), np.zeros((n, k))
    for t, m in enumerate(alive):
        at = begin[:m] + t
        forward[at] = e[at] + (step(forward[at - 1]) if t else priors[order[:m]])
    for t in range(len(alive) - 2, -1, -1):
        at = begin[: alive[t + 1]] + t
        backward[at] = step(backward[at + 1] + e[at + 1])
    post = forward + backward
    post = np.exp(post - post.max(1, keepdims=True))
    post /= post.sum(1, keepdims=True)
    best = post.argmax(1)
    return best, post[np.arange(n), best]


def label_counts(documents: DataFrame, by: list[str]) -> DataFrame:
    """Labelled documents by `by` and language code, counted map-side over all documents."""
    return documents.select(*by, language_code("lang").alias("code")).where("code is not null").groupBy(*by, "code").agg(F.count(F.lit(1)).alias("n"))


def suffixes(c: Column) -> Column:
    """The different address suffixes of a text's links."""
    hosts = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(_HOST), F.lit(1))
    ends = F.transform(hosts, lambda h: F.lower(F.regexp_extract(h, r"\.([A-Za-z]{2,24})\.?$", 1)))
    return F.array_distinct(F.filter(ends, lambda x: x != ""))


def evidence(documents: DataFrame, *, most: int = 20_000) -> tuple[DataFrame, dict[str, int], dict[str, dict[str, int]]]:
    """(documents, labelled documents of each language, those of each address suffix).

    documents: doc_id, text, code, and own, suffixes and hosts. own maps language codes to the labelled documents of the
    document's source, of which there may be many and one may hold a third of all documents: few enough to be broadcast
    by count, or joined by lookup. The counts by suffix come as a dictionary where there are at most `most` suffixes; else
    it is empty, and hosts has their sums over the document's suffixes.
    """
    total = {r["code"]: r["n"] for r in label_counts(documents, []).collect()}  # bounded by the codes
    docs = spread(documents.select("doc_id", "text", "lang", "source")).select("doc_id", "text", "lang", F.coalesce("source", F.lit("")).alias("source"), suffixes(F.col("text")).alias("suffixes"))
    as_map = lambda df, key, name: df.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("code", "n"))).alias(name))
    # The counts read the table itself: they need no spreading, and no text but for the links' suffixes.
    sources = as_map(label_counts(documents.select("lang", F.coalesce("source", F.lit("")).alias("source")), ["source"]), "source", "own")
    linked = documents.select("lang", F.explode(suffixes(F.col("text"))).alias("suffix"))
    hosts = as_map(label_counts(linked, ["suffix"]), "suffix", "hosts")
    some = hosts.limit(most + 1).collect()
    joined = checked_lookup(docs, sources, ["source"])
    if len(some) <= most:
        joined = joined.withColumn("hosts", F.lit(None).cast("map<string,bigint>"))
    else:
        each = documents.select("doc_id", F.explode(suffixes(F.col("text"))).alias("suffix")).distinct()
        each = checked_lookup(each, label_counts(linked, ["suffix"]).groupBy("suffix").agg(F.collect_list(F.struct("code", "n")).alias("held")), ["suffix"], "inner")
        sums = each.select("doc_id", F.inline("held")).groupBy("doc_id", "code").agg(F.sum("n").alias("n"))
        joined = joined.join(as_map(sums, "doc_id", "hosts"), "doc_id", "left")
    out = joined.select("doc_id", "text", language_code("lang").alias("code"), "own", "suffixes", "hosts")
    return out, total, {r["suffix"]: dict(r["hosts"]) for r in some} if len(some) <= most else {}


def _bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts of more than FIT_CHARS characters cut to their first sentences."""
    for pdf in batches:
        texts = []
        for text in pdf["text"]:
            if len(text) > FIT_CHARS:
                parts = sentences(text)
                ends = np.cumsum([len(p) + 1 for p in parts])
                text = "\n".join(parts[: int((ends <= FIT_CHARS).sum())] or [p[:FIT_CHARS] for p in parts[:1]])
            texts.append(text)
        yield pd.DataFrame({"code": pdf["code"], "text": texts})


def fit(documents: DataFrame, counts: dict[str, int], *, per_language: int = FIT_DOCUMENTS) -> Classifier:
    """A classifier from at most per_language labelled documents a language, drawn evenly by a hash of their ids.

    counts: labelled documents of each language. Long texts are only drawn where short ones are too few, and of each a
    bounded number of sentences.
    """
    u = (F.xxhash64("doc_id", F.lit(5)).cast("double") / F.lit(2.0**64)) + 0.5
    share = F.lit(0.0)
    for code, n in counts.items():
        share = F.when(F.col("code") == code, min(1.0, 1.5 * per_language / n)).otherwise(share)
    from pyspark.sql import Window

    drawn = documents.select("doc_id", "text", language_code("lang").alias("code"), u.alias("u")).where((F.col("u") < share) & (F.length("text") > 0))
    rank = F.row_number().over(Window.partitionBy("code").orderBy(F.length("text") > FIT_CHARS, "u", "doc_id"))
    rows = drawn.withColumn("r", rank).where(F.col("r") <= per_language).select("code", "text").mapInPandas(_bounded, "code string, text string").collect()
    return Classifier.fit([(r["code"], r["text"]) for r in sorted(rows, key=lambda r: (r["code"], r["text"]))])


def prior_of(code: str | None, own: dict | None, hosts: dict | None, langs: list[str], base: np.ndarray) -> np.ndarray:
    """Log-prior of a document: its source's labels smoothed towards all, its links' suffix, and its declared label."""
    p = base
    for counts in (own, hosts):
        if counts:
            counts = dict(counts)
            n = np.array([counts.get(x, 0) for x in langs], dtype=float)
            p = (n + SMOOTH * p) / (n.sum() + SMOOTH)
    said = np.full(len(langs), 0.1 / max(1, len(langs)))
    if code in langs:
        said[langs.index(code)] += 0.9
        p = p * said
    p = np.maximum(p / p.sum(), 1e-6)
    return np.log(p / p.sum())


def judge(documents: DataFrame, *, per_language: int = FIT_DOCUMENTS) -> DataFrame:
    """(doc_id, declared, segments, languages) of every document.

    declared: the code that its label names, null if none. segments: its runs of sentences as structs of lang,
    confidence (the mean of the sentences'), words, and sentences (how many). languages: lang, confidence, words of each
    language that the document holds: that of most words, and each further one with at least a full sentence of
    SURE confidence. Null, empty and blank texts, and texts of code, links and signs only, have empty lists. Repeated
    rows are judged each; an empty table gives no rows; further columns are ignored. Any number of languages may be
    labelled; texts in a language that no label names get the nearest one, with its confidence.
    """
    known, total, by_suffix = evidence(documents)
    model = fit(documents, total, per_language=per_language) if total else None
    if model is None or not model.langs:
        kind = "array<struct<lang:string,confidence:double,words:int,sentences:int>>"
        return documents.select("doc_id", language_code("lang").alias("declared"), F.array().cast(kind).alias("segments"), F.array().cast("array<struct<lang:string,confidence:double,words:int>>").alias("languages"))
    base = np.array([total.get(x, 0) + 1.0 for x in model.langs])
    state = documents.sparkSession.sparkContext.broadcast((model.langs, model.table, base / base.sum(), by_suffix))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        langs, table, base, by_suffix = state.value
        model = Classifier(langs, table)
        for whole in batches:
            for begin in range(0, len(whole), BATCH):
                pdf = whole.iloc[begin : begin + BATCH]
                parts = [sentences(t) for t in pdf["text"]]
                # A sentence that several documents have is scored once.
                places: dict[str, int] = {}
                at = [places.setdefault(s, len(places)) for p in parts for s in p]
                score = model.score(list(places))[at] if at else np.zeros((0, len(langs)))
                priors = [prior_of(c, o, _links(x, h, by_suffix), langs, base) for c, o, x, h in zip(pdf["code"], pdf["own"], pdf["suffixes"], pdf["hosts"], strict=True)]
                best, sure = chains(score, [len(p) for p in parts], np.array(priors))
                ends = np.cumsum([len(p) for p in parts])
                made = [document(p, best[e - len(p) : e], sure[e - len(p) : e], langs) for p, e in zip(parts, ends.tolist(), strict=True)]
                yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "declared": pdf["code"].to_numpy(), "segments": [a for a, _ in made], "languages": [b for _, b in made]})

    schema = "doc_id bigint, declared string, segments array<struct<lang:string,confidence:double,words:int,sentences:int>>, languages array<struct<lang:string,confidence:double,words:int>>"
    return known.mapInPandas(run, schema)


def _links(found: Sequence[str] | None, sums: dict | None, by_suffix: dict[str, dict[str, int]]) -> dict[str, int] | None:
    """Labelled documents by language that link to any of the suffixes."""
    if sums is not None or found is None or not len(found):
        return sums
    out: dict[str, int] = {}
    for x in found:
        for code, n in by_suffix.get(x, {}).items():
            out[code] = out.get(code, 0) + n
    return out


def document(parts: list[str], best: np.ndarray, sure: np.ndarray, langs: list[str]) -> tuple[list[dict], list[dict]]:
    """(segments, languages) of one document's sentences, given the language and confidence of each."""
    if not parts:
        return [], []
    units = [_units(p) for p in parts]
    segments: list[dict] = []
    words: dict[int, int] = {}
    trust: dict[int, float] = {}
    full: dict[int, bool] = {}
    for p, b, c, n in zip(parts, best.tolist(), sure.tolist(), units, strict=True):
        if segments and segments[-1]["lang"] == langs[b]:
            last = segments[-1]
            last["confidence"] += (c - last["confidence"]) / (last["sentences"] + 1)
            last["words"] += n
            last["sentences"] += 1
        else:
            segments.append({"lang": langs[b], "confidence": c, "words": n, "sentences": 1})
        words[b] = words.get(b, 0) + n
        trust[b] = max(trust.get(b, 0.0), c)
        full[b] = full.get(b, False) or (n >= WORDS and c >= SURE and bool(_FULL.search(p)))
    main = max(words, key=lambda b: (words[b], trust[b], -b))
    held = [b for b in words if b == main or full[b]]
    return segments, [{"lang": langs[b], "confidence": trust[b], "words": words[b]} for b in sorted(held, key=lambda b: (-words[b], b))]


def cases(documents: DataFrame, *, per_language: int = FIT_DOCUMENTS) -> DataFrame:
    """(doc_id, lang_code) of each document with prose whose label is missing or wrong or whose prose is mixed."""
    judged = judge(documents, per_language=per_language)
    names = F.col("languages.lang")
    wrong = F.col("declared").isNull() | ~F.array_contains(names, F.col("declared")) | (F.size(names) > 1)
    return judged.where((F.size(names) > 0) & wrong).select("doc_id", F.explode(names).alias("lang_code"))
