"""Garbled text from wrong character encodings.

A damaged text was, at one or more steps, written in one encoding and read in another. The chain of steps is latent:
expectation-maximization over all records alternates between the posterior of each chain for each word (given a
character model of undamaged text and the chain's frequency in the record's source and field) and re-estimating model
and frequencies from the words as repaired. Single records are weak evidence, "TíS" may be a name; the pooled corpus
knows "T’S". Each record is then decided, and repaired, by its posterior over chains.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.plans.parallel import spread, tasks
from panelloom.session import shared_checkpoints

# Single-byte encodings by which text is misread, or in which it was written (Python's codec names).
SINGLE = ("cp1252", "cp1251", "mac_roman", "cp437", "cp850", "cp1250", "koi8_r", "cp866", "iso8859_2", "cp1254", "cp1253", "mac_cyrillic", "mac_latin2")
# Multi-byte encodings.
WIDE = ("gb18030", "big5", "shift_jis", "euc_kr")
#: Buckets of the hashed character model (its size, and what is broadcast, never grows) and of sources.
BUCKETS, SOURCES = 1 << 20, 1 << 14
#: Rounds of expectation-maximization; share of undamaged records assumed at first.
ROUNDS, CLEAN = 3, 0.95
#: Chance that a word of a damaged record is undamaged, and share of damaged records of which only a part is damaged, of
#: any size with the same chance.
SPARED, PARTLY = 0.1, 0.1
#: Logarithm of the chance of a capital after a small letter.
ODD_CASE = -5.0
#: A character in fewer than this share of all words starts without support in the character model.
RARE = 1 / 2000
#: Longest word (run without ASCII blanks) that is undone as a whole only; chains are undone over the whole of longer
#: ones too, and besides in pieces of this size, as only a part of such a run may be damaged.
WORD = 400

_BLANKS = re.compile(r"([ \t\r\n]+)")
_ODD_CASE = re.compile("(?<=[a-zß-öø-ÿа-яё])[A-ZÀ-ÖØ-ÞА-ЯЁ]")
_GONE = re.compile("(�+)")
_LOST = re.compile("[�\u0080-\u0084\u0086-\u009f]")
_UTF8 = re.compile("[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xef][\x80-\xbf]{2}|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf4][\x80-\xbf]{3}")


@lru_cache(None)
def _table(name: str) -> tuple[dict[int, int], list[str]]:
    """Upper half of a single-byte encoding: character -> byte, and byte - 128 -> character; undefined bytes are controls."""
    chars = []
    for b in range(128, 256):
        try:
            chars.append(bytes([b]).decode(name))
        except UnicodeDecodeError:
            chars.append(chr(b))
    back = {ord(c): 128 + i for i, c in enumerate(chars)}
    for b in range(128, 160):  # a control is what an undefined or unread byte becomes
        back.setdefault(b, b)
    if name == "cp1252":
        back[0xA0] = 0xA0
    return back, chars


@lru_cache(None)
def _recoded(read: str, written: str) -> dict[int, str]:
    """Character as read -> character as written, both in single-byte encodings."""
    back, chars = _table(read)[0], _table(written)[1]
    return {c: chars[b - 128] for c, b in back.items()}


@lru_cache(None)
def _as_bytes(read: str) -> dict[int, str]:
    """Character as read -> its byte as a character under 256; other characters under 256 move out of the way."""
    back = _table(read)[0]
    return {c: chr(0xF0000 + c) for c in range(128, 256)} | {c: chr(b) for c, b in back.items()}


@lru_cache(None)
def _from_bytes(read: str) -> dict[int, str]:
    chars = _table(read)[1]
    return {128 + i: c for i, c in enumerate(chars)} | {0xF0000 + c: chr(c) for c in range(128, 256)}


def _sequence(m: re.Match) -> str:
    return m[0].encode("latin-1").decode("utf-8", "replace")


def undo_utf8(word: str, read: str) -> str | None:
    """UTF-8 that was read as `read`: its valid multi-byte sequences are restored, the rest stays; None if there is none."""
    if read in WIDE:
        try:
            raw = word.encode(read)
            out = raw.decode("utf-8", "replace")
        except UnicodeError:
            return None
        return None if "�" in out[:-1] or out == word else out
    moved, found = _UTF8.subn(lambda m: "\U000e0000" + _sequence(m) + "\U000e0001", word.translate(_as_bytes(read)))
    if not found:
        return None
    # What was restored isn't translated back.
    parts = re.split("\U000e0000(.*?)\U000e0001", moved)
    return "".join(p if i % 2 else p.translate(_from_bytes(read)) for i, p in enumerate(parts))


def _wide_enough(read: str, written: str, word: str, above: list[str]) -> bool:
    """Whether a word has enough characters beyond ASCII for a multi-byte encoding: two or more, or ideographs."""
    if read in WIDE:
        return any(c >= "\u2e80" for c in above)
    return len(above) >= 2 and (written == "utf-8" or 2 * len(above) >= len(word))


def misread_utf8(word: str) -> list[str]:
    """What a word may have been if all of it beyond ASCII is UTF-8 that was read in some other encoding."""
    out = []
    above = [c for c in word if c >= "\x80"]
    for r, w in STEPS:
        if w != "utf-8" or not _wide_enough(r, w, word, above):
            continue
        whole = r in WIDE or _UTF8.sub("", word.translate(_as_bytes(r))).isascii()
        got = undo_utf8(word, r) if whole else None
        if got is not None:
            out.append(got)
    return out


@lru_cache(None)
def _readable(read: str) -> frozenset[str]:
    """Characters beyond ASCII that reading in a single-byte encoding can give."""
    return frozenset(map(chr, _table(read)[0]))


def undo(word: str, read: str, written: str, odd: set[str] | None = None) -> str | None:
    """A word as written, if it was written in `written` and read in `read`; None if that can't be or changes nothing.

    odd: the word's characters beyond ASCII, where they are known already.
    """
    if written == "utf-8":
        return undo_utf8(word, read)
    if not (_readable(read) >= ({c for c in word if c >= "\x80"} if odd is None else odd)):
        return None
    if written in WIDE:
        back = _table(read)[0]
        try:
            return bytes(ord(c) if c < "\x80" else back[ord(c)] for c in word).decode(written)
        except (UnicodeDecodeError, ValueError):
            return None
    out = word.translate(_recoded(read, written))
    return None if out == word else out


#: Chains of one step: (read in, written in); identity is chain 0 and has no step.
STEPS: tuple[tuple[str, str], ...] = (
    *((r, "utf-8") for r in (*SINGLE, *WIDE)),
    *((r, w) for r in SINGLE for w in SINGLE[:9] if r != w),
    *((r, w) for r in ("cp1252", "cp1251", "mac_roman", "cp437") for w in WIDE),
    ("latin_1", "cp1252"),
)
#: Name of a chain: its steps in the order of their undoing. Only UTF-8 steps, which can be told for sure, go on.
MOST_STEPS = 3


def openings(allowed: set[str] | None, known: Callable[[str], bool]) -> list[tuple[str, str, str, frozenset[str] | None]]:
    """(name, read, written, characters) of the one-step chains to try.

    A single-byte step is worth trying on words of such characters only as it turns into ones known in undamaged text.
    """
    out = []
    for r, w in STEPS:
        name = f"{r}<{w};"
        if allowed is not None and name not in allowed:
            continue
        chars = _readable(r) if r not in WIDE else None
        if w != "utf-8" and w not in WIDE:
            chars = frozenset(chr(c) for c, to in _recoded(r, w).items() if known(to))
        out.append((name, r, w, None if w == "utf-8" else chars))
    return out


def candidates(word: str, steps: list[tuple[str, str, str, frozenset[str] | None]], allowed: set[str] | None = None) -> list[tuple[str, str]]:
    """(chain, word as written) for each chain that could have made the word; steps: openings, allowed: the chains to try."""
    out: list[tuple[str, str]] = []
    stack = [("", word, 0)]
    while stack:
        chain, now, depth = stack.pop()
        above = [c for c in now if c >= "\x80"]
        odd = set(above)
        for name, r, w, chars in steps:
            if chars is not None and (depth or not odd <= chars):
                continue
            if (w == "utf-8" or w in WIDE) and not _wide_enough(r, w, now, above):
                continue
            name = chain + name
            if depth and allowed is not None and name not in allowed:
                continue
            got = undo(now, r, w, odd)
            if got is None or _LOST.search(got):
                continue
            out.append((name, got))
            if w == "utf-8" and depth + 1 < MOST_STEPS and not got.isascii():
                stack.append((name, got, depth + 1))
    return out


class CharModel:
    """Interpolated character trigrams in one hashed table of counts."""

    def __init__(self, counts: np.ndarray):
        self.n, self.total = array("d", np.ascontiguousarray(counts, dtype=np.float64).tobytes()), float(counts[0]) + 1.0
        self.words = self.n[self.slots("")[0][0]]
        self.chars: dict[str, float] = {}
        self.grams: dict[str, float] = {}

    def held(self, ch: str) -> float:
        """How often a character occurs."""
        got = self.chars.get(ch)
        if got is None:
            got = self.chars[ch] = self.n[self.slots(ch)[0][0]]
        return got

    def doubtful(self, word: str) -> bool:
        """Whether a word is better left out at first: it is UTF-8 misread from characters that occur, or has rare ones.

        A word that can be misread UTF-8, but of characters that don't occur, is counted whatever its characters.
        """
        as_written = misread_utf8(word)
        return any(not self.rare(w, 1.0) for w in as_written) if as_written else self.rare(word, RARE * self.words)

    def rare(self, word: str, least: float) -> bool:
        """Whether a word has a character beyond ASCII that occurs less often than `least` times."""
        return any(ch >= "\x80" and self.held(ch) < least for ch in word)

    @staticmethod
    def slots_of(gram: str) -> tuple[int, int, int]:
        """Buckets of the unigram, bigram and trigram that end at the last of three characters; bucket 0 counts all."""
        (a, b, c), top = map(ord, gram), BUCKETS - 1
        return 1 + (c * 2654435761 >> 7) % top, 1 + ((b * 40503 + c) * 2246822519 >> 9) % top, 1 + (((a * 65599 + b) * 40503 + c) * 3266489917 >> 11) % top

    @classmethod
    def slots(cls, word: str) -> list[tuple[int, int, int]]:
        """slots_of each character of a word and its end."""
        s = f"\x02\x02{word.lower()}\x03"
        return [cls.slots_of(s[i : i + 3]) for i in range(len(s) - 2)]

    def one(self, gram: str) -> float:
        """Log-probability of the last of three characters after the first two."""
        n, (_, b, c) = self.n, map(ord, gram)
        one, two, three = self.slots_of(gram)
        start = gram[1] == "\x02"
        before = self.total if start else n[1 + (b * 2654435761 >> 7) % (BUCKETS - 1)]
        pair = self.total if start else n[self.slots_of("\x02" + gram[:2])[1]]
        # One is taken off each count: what only this word attests is no evidence for it. No n-gram occurs more often
        # than its parts: a bucket that others share doesn't make it likely.
        first = n[one]
        second = min(n[two], first, before)
        third = min(n[three], second, pair)
        p1 = (max(first - 1.0, 0.0) + 0.05) / (self.total + 5000.0)
        p2 = (max(second - 1.0, 0.0) + 4.0 * p1) / (before + 3.0)
        return math.log((max(third - 1.0, 0.0) + 4.0 * p2) / (pair + 3.0))

    def logp(self, word: str) -> float:
        """Log-probability of a word. Letters count in lower case; a capital after a small letter is rare in any script."""
        p = ODD_CASE * len(_ODD_CASE.findall(word)) if not word.islower() else 0.0
        s, grams = f"\x02\x02{word.lower()}\x03", self.grams
        for i in range(len(s) - 2):
            g = s[i : i + 3]
            v = grams.get(g)
            if v is None:
                if len(grams) > 300_000:
                    grams.clear()
                v = grams[g] = self.one(g)
            p += v
        return p


def _runs(word: str) -> list[str]:
    """A word, or what lies between the lost characters of a long one, and at odd places those."""
    return [word] if len(word) <= WORD else _GONE.split(word)


def _pieces(word: str) -> list[str]:
    return [word] if len(word) <= WORD else [word[i : i + WORD] for i in range(0, len(word), WORD)]


class Judge:
    """Posterior of chains given a character model and the chains' frequencies per source."""

    def __init__(self, model: CharModel, prior: dict[int, dict[str, float]], allowed: set[str] | None):
        self.model, self.prior, self.allowed, self.known = model, prior, allowed, {}
        self.steps = openings(allowed, self.seen)

    def options(self, word: str) -> tuple[float, list[tuple[str, str, float]], list[tuple[str, str, float]]]:
        """(log-probability as it is, (chain, as written, log-probability), those that gain on a spared word, with the gain)."""
        got = self.known.get(word)
        if got is None:
            plain = self.model.logp(word)
            opts = [(c, w, self.model.logp(w)) for c, w in candidates(word, self.steps, self.allowed)]
            least = plain + math.log(SPARED) - math.log(1 - SPARED)
            got = (plain, opts, [(c, w, p - least) for c, w, p in opts if p > least])
            if len(self.known) > 100_000:
                self.known.clear()
            if len(word) <= 64:
                self.known[word] = got
        return got

    def seen(self, ch: str) -> bool:
        return ch < "\x80" or self.model.held(ch) >= 1.0

    def freq(self, source: int, chain: str) -> float:
        own = self.prior.get(source) or self.prior[-1]
        return own.get(chain, self.prior[-1].get(chain, 1e-9))

    def word(self, source: int, word: str) -> list[tuple[str, str, float]]:
        """(chain, word as written, posterior); chain '' is identity."""
        plain, opts, _ = self.options(word)
        scored = [("", word, math.log(self.freq(source, "")) + plain)] + [(c, w, math.log(self.freq(source, c)) + p) for c, w, p in opts]
        top = max(s for _, _, s in scored)
        weights = [math.exp(s - top) for _, _, s in scored]
        total = sum(weights)
        return [(c, w, x / total) for (c, w, _), x in zip(scored, weights, strict=True)]

    def units(self, source: int, word: str) -> list[list[tuple[str, str, float]]]:
        """word() of a word, or of the pieces of a long one that isn't damaged as a whole."""
        whole = self.word(source, word)
        if len(word) <= WORD or max(whole, key=lambda x: x[2])[0]:
            return [whole]
        return [self.word(source, p) for p in _pieces(word) if not p.isascii()]

    def record(self, source: int, text: str) -> tuple[str, float, str]:
        """(chain, posterior, text as written) of a record; chain '' with its posterior if it is undamaged."""
        split = [(r, k % 2 == 0 and not r.isascii()) for p in _BLANKS.split(text) for k, r in enumerate(_runs(p))]
        parts = [p for p, _ in split]
        words: list[tuple[int, str]] = []
        long: list[tuple[int, range]] = []  # a long run and the places of its pieces
        for i, (p, judged) in enumerate(split):
            if judged:
                words += [(i, piece) for piece in _pieces(p)]
                if len(p) > WORD:
                    long.append((i, range(len(words) - len(_pieces(p)), len(words))))
        if not words:
            return "", 1.0, text
        opts = [self.options(w) for _, w in words]
        # In a damaged record each word is damaged, or spared by chance; where a chain can't have made a word, it was
        # spared. A chain that gains on no word is no better than damage that spared them all.
        best: dict[str, dict[int, str]] = {}
        gains: dict[str, float] = {}
        for i, (_, _, gainful) in enumerate(opts):
            for chain, r, gain in gainful:
                gains[chain] = gains.get(chain, 0.0) + gain
                best.setdefault(chain, {})[i] = r
        whole = sum(o[0] for o in opts)
        # Pieces end inside multi-byte sequences: a chain that does better over the whole of a long run is undone there.
        for i, places in long:
            plain, undone, _ = self.options(parts[i])
            whole += plain - sum(opts[k][0] for k in places)
            least = plain + len(places) * math.log(SPARED) - math.log(1 - SPARED)
            for chain, r, p in undone:
                in_pieces = sum(g for k in places for c, _, g in opts[k][2] if c == chain)
                if p - least > in_pieces:
                    gains[chain] = gains.get(chain, 0.0) + p - least - in_pieces
                    best.setdefault(chain, {}).update({k: "" for k in places} | {places[0]: r})
        if not best:
            return "", 1.0, text
        base = whole + len(words) * math.log(SPARED)
        score = {"": math.log(self.freq(source, "")) + whole}
        for chain, gain in gains.items():
            k, n = len(best[chain]), len(words)
            # A part of k words of n: all sizes of the part, and all parts of a size, have the same chance.
            part = whole + gain + k * (math.log(SPARED) - math.log(1 - SPARED)) - math.log((n + 1) * math.comb(n, k))
            most, least = max(base + gain, part), min(base + gain, part)
            weights = (1 - PARTLY, PARTLY) if base + gain >= part else (PARTLY, 1 - PARTLY)
            score[chain] = math.log(self.freq(source, chain)) + most + math.log(weights[0] + weights[1] * math.exp(max(-700.0, least - most)))
        most = max(score.values())
        norm = sum(math.exp(max(-700.0, s - most)) for s in score.values())
        plain = math.exp(max(-700.0, score[""] - most)) / norm
        if plain >= 0.5 or not best:
            return "", plain, text
        # Chains that lead to the same text share its posterior.
        shared: dict[tuple, float] = {}
        for c, fixed in best.items():
            key = tuple(sorted(fixed.items()))
            shared[key] = shared.get(key, 0.0) + math.exp(max(-700.0, score[c] - most)) / norm
        outcome = max(shared, key=lambda o: (shared[o], o))
        top = max((c for c, fixed in best.items() if tuple(sorted(fixed.items())) == outcome), key=lambda c: (score[c], c))
        for i, places in long:  # damage of another kind in the same record
            if not any(k in best[top] for k in places):
                c, r, p = max(self.word(source, parts[i]), key=lambda x: x[2])
                if c and p > 0.9:
                    best[top].update({k: "" for k in places} | {places[0]: r})
        pieces: dict[int, str] = {}
        for k, (i, w) in enumerate(words):
            new = best[top].get(k, w)
            if new == w:  # here too
                c, r, p = max(self.word(source, w), key=lambda x: x[2])
                new = r if c and p > 0.9 else w
            pieces[i] = pieces.get(i, "") + new
        return top, 1 - plain, "".join(pieces.get(i, p) for i, p in enumerate(parts))


def _source_bucket(sources: pd.Series) -> list[int]:
    import zlib

    return [zlib.crc32(str(s).encode("utf-8", "replace")) % SOURCES if s is not None else SOURCES for s in sources]


def word_table(records: DataFrame, text: str, source: str | Sequence[str] | None) -> DataFrame:
    """(source, word, n): distinct words with a character beyond ASCII, counted map-side over all records."""
    src = _source(source)
    words = records.select(src.alias("source"), F.explode(F.split(F.col(text), r"[ \t\r\n]+")).alias("word")).where(F.col("word").rlike(r"[^\x00-\x7F]"))
    return words.groupBy("source", "word").agg(F.count(F.lit(1)).alias("n"))


def _source(source: str | Sequence[str] | None) -> Column:
    """One text of the columns that name a record's source and field."""
    named = [source] if isinstance(source, str) else list(source or ())
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(named)])) if named else F.lit("")


def fit(records: DataFrame, *, text: str, source: str | Sequence[str] | None = None, rounds: int = ROUNDS) -> tuple[np.ndarray, dict[int, dict[str, float]], set[str]]:
    """(character counts, chain frequencies per source bucket, chains in use) by expectation-maximization over all records.

    Each round is one distributed pass over the distinct words; the driver gets the hashed model (BUCKETS numbers) and
    the chains' frequencies (at most SOURCES + 1 times the number of chains that occur).
    """
    shared_checkpoints(records.sparkSession)
    # The words are few bytes and much work: they are spread by an explicit number, which isn't coalesced at run time.
    words = word_table(records, text, source)
    words = words.repartition(tasks(words)).checkpoint()
    sc = records.sparkSession.sparkContext
    prior: dict[int, dict[str, float]] = {}
    allowed: set[str] | None = None
    counts: np.ndarray | None = None
    for step in range(rounds + 2):
        # Step 0 counts the words that can't be misread UTF-8. Step 1 counts those of frequent characters, but for words
        # that read as UTF-8 have known characters. Then expectation and maximization alternate.
        state = sc.broadcast((counts, prior, allowed, step))

        def count(batches: Iterator[pd.DataFrame], state=state) -> Iterator[pd.DataFrame]:
            have, prior, allowed, step = state.value
            judge = Judge(CharModel(have), prior, allowed) if step > 1 else None
            first = CharModel(have) if step == 1 else None
            table, chains = np.zeros(BUCKETS), {}
            for pdf in batches:
                for source, word, n in zip(_source_bucket(pdf["source"]), pdf["word"], pdf["n"], strict=True):
                    units = []
                    for run in _runs(word):
                        if "�" in run or run.isascii() or (step < 2 and len(run) > WORD and misread_utf8(run)):
                            continue  # no long run is UTF-8 by chance
                        if judge:
                            units += judge.units(source, run)
                            continue
                        for piece in _pieces(run):
                            if not ((step == 0 and misread_utf8(piece)) or (first and first.doubtful(piece))):
                                units.append([("", piece, 1.0)])
                    for unit in units:
                        for chain, written, p in unit:
                            if p < 1e-4:
                                continue
                            for one, two, three in CharModel.slots(written):
                                table[one] += n * p
                                table[two] += n * p
                                table[three] += n * p
                                table[0] += n * p
                            if judge:
                                for s in (source, -1):
                                    chains[s, chain] = chains.get((s, chain), 0.0) + n * p
            at = np.flatnonzero(table)
            yield pd.DataFrame({"bucket": at.astype("int64"), "source": -2, "chain": "", "weight": table[at]})
            if chains:
                yield pd.DataFrame([(0, s, c, w) for (s, c), w in chains.items()], columns=["bucket", "source", "chain", "weight"])

        got = words.mapInPandas(count, "bucket bigint, source int, chain string, weight double").groupBy("source", "bucket", "chain").agg(F.sum("weight").alias("weight")).toPandas()
        model = got[got.source == -2]
        counts = np.zeros(BUCKETS)
        counts[model.bucket.to_numpy()] = model.weight.to_numpy()
        seen = got[got.source != -2]
        if not len(seen):
            all_chains = [f"{r}<{w};" for r, w in STEPS]
            prior = {-1: {"": CLEAN} | {c: (1 - CLEAN) / len(all_chains) for c in all_chains}}
            # Chains of several steps start an order of magnitude rarer for each step.
            for c in [f"{r}<utf-8;" for r, w in STEPS if w == "utf-8"]:
                for d in [f"{r}<utf-8;" for r, w in STEPS if w == "utf-8"]:
                    prior[-1][c + d] = prior[-1][c] * 0.1
                    prior[-1][c + d + d] = prior[-1][c] * 0.01
            continue
        base = seen[seen.source == -1].groupby("chain").weight.sum()
        total = base.sum()
        prior = {-1: {c: (w + 1e-3) / (total + 1) for c, w in base.items()}}
        prior[-1].setdefault("", CLEAN)
        allowed = {c for c, w in base.items() if c and w >= 0.2}
        # A chain's beginnings must stay open for its later steps.
        for c in list(allowed):
            steps = c.split(";")[:-1]
            allowed |= {";".join(steps[:k]) + ";" for k in range(1, len(steps))}
        for s, part in seen[seen.source >= 0].groupby("source"):
            own, n = part.set_index("chain").weight, part.weight.sum()
            # Smoothed towards all sources: a source of few records says little.
            prior[int(s)] = {c: (own.get(c, 0.0) + 50.0 * p) / (n + 50.0) for c, p in prior[-1].items()}
    return counts, prior, allowed or set()


def repair(records: DataFrame, *, key: str, text: str, source: str | Sequence[str] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """(key, damaged, chain, posterior, repaired, restored) of each record with a text.

    damaged: the posterior of damage exceeds one half, or characters are lost (U+FFFD, or controls that no text has).
    chain names the steps to undo ("read<written;"), '' if none is known; repaired is the text as written as far as it
    can be restored; restored is false where characters stay lost. Null, empty and blank texts give no row; texts of
    ASCII characters only are never damaged; escapes (entities, percent signs) are left alone; repeated rows give a row
    each; an empty table gives none. source names the columns whose values differ in their habits (a null is a value too), such
    as the record's source and, where the texts of several fields lie under each other, the field.
    """
    counts, prior, allowed = fit(records, text=text, source=source, rounds=rounds)
    state = records.sparkSession.sparkContext.broadcast((counts, prior, allowed))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, prior, allowed = state.value
        judge = Judge(CharModel(counts), prior, allowed)
        for pdf in batches:
            out = [judge.record(s, t) for s, t in zip(_source_bucket(pdf["source"]), pdf["text"], strict=True)]
            lost = [bool(_LOST.search(t)) for t in pdf["text"]]
            still = [bool(_LOST.search(r)) for _, _, r in out]
            yield pd.DataFrame(
                {
                    "_key": pdf["_key"],
                    "damaged": [bool(c) or x for (c, _, _), x in zip(out, lost, strict=True)],
                    "chain": [c for c, _, _ in out],
                    "posterior": [p for _, p, _ in out],
                    "repaired": [r for _, _, r in out],
                    "restored": [not x for x in still],
                }
            )

    kind = records.schema[key].dataType.simpleString()
    src = _source(source)
    filled = spread(records.select(F.col(key).alias("_key"), src.alias("source"), F.col(text).alias("text"))).where(F.length(F.btrim("text")) > 0)
    plain = filled.where(~F.col("text").rlike(r"[^\x00-\x7F]")).select("_key", F.lit(False).alias("damaged"), F.lit("").alias("chain"), F.lit(1.0).alias("posterior"), F.col("text").alias("repaired"), F.lit(True).alias("restored"))
    judged = filled.where(F.col("text").rlike(r"[^\x00-\x7F]")).mapInPandas(run, f"_key {kind}, damaged boolean, chain string, posterior double, repaired string, restored boolean")
    return judged.unionByName(plain).withColumnRenamed("_key", key)
