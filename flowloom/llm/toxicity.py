"""Toxicity: Levenshtein automata run through a lexicon trie, with context-window scores.

The lexicon is a list of terms plus what the labelled training rows teach: words, and beginnings of words,
that a fair share of the toxic documents hold and hardly any other. A word of a text is turned into a Levenshtein automaton (bit
sets of positions, one for each number of errors) and walked through the trie of terms, so misspelled
terms are found too; longer terms allow more errors. The window of words around each hit tells quotation
(quotation marks, verbs of saying, talk about words) from abuse (second person). Counts of these kinds of
hits feed a logistic model, fitted by Newton steps whose sums every partition forms for itself.

A text is cut to tokens at white space. A token is looked up whole (without marks around it) and, where marks
stand inside it, in its runs of letters and digits too; the nearest term counts, at a tie the first by name. Texts
without spaces between words are one token, whose beginning alone is compared with stems.

Edge cases: NULL and empty texts have no hits and get the score of a clean text; a label is taken only where it is
not NULL (several for one id: the largest); labels of held-out rows are never looked at; without labelled rows
fixed weights hold; texts and words of any length are read whole; repeated rows each get their score; an empty
table gives an empty result. Other columns of docs and labels are not read and may have any name.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.llm.common import release, small_batches, staged, table
from flowloom.llm.learning import bounded, crc_mod, matrix, summed, unique_labels

#: Labelled rows from which new lexicon terms are learned, at most.
LEXICON_ROWS = 4000
#: What a learned term needs: toxic rows and their share, share of toxic rows among its rows, log likelihood gain over chance.
LEAST_ROWS, TERM_SHARE, WORD_SHARE, TERM_PURITY, TERM_GAIN = 6, 0.01, 0.08, 0.5, 14.0
#: Letters of a learned stem, and how many different words it must begin.
STEMS, STEM_WORDS = (4, 5, 6, 7), 4
#: A term's weight from which it counts as strong; the weight of the terms above.
STRONG, GIVEN = 2.0, 4.0
WINDOW, KINDS, CACHE_WORDS = 6, 8, 200_000
#: The terms that hold without any labels.
TERMS = ("idiot", "moron", "stupid", "loser", "worthless", "pathetic", "disgusting", "scum", "trash", "clown")
#: Words that mark a report or talk about a word, and the second person, in four languages.
REPORTS = frozenset("said says wrote writes called calls quote quoted quotes reported word words term terms insult insults means sagte schrieb nannte wort dit écrit mot dijo escribió palabra".split())
PERSONS = frozenset("you your you're youre u ur yourself du dich dein ihr euch tu toi te vous votre tú usted ustedes eres".split())
MARKS = "\"'“”„«»‘’"
#: Fixed value: the weights without labels (intercept first).
PLAIN_WEIGHTS = (-4.0, 4.0, 2.5, -0.5, 1.0, 1.0, 0.5, 1.0, 0.5)
_STRIP = re.compile(r"^[\W_]+|[\W_]+$")
_RUNS = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_WORD = re.compile(r"[^\W\d_]{3,}")


def errors_for(term: str) -> int:
    """Errors that a term of this length allows; none for a stem."""
    return 0 if term.endswith("*") or len(term) < 5 else 1 if len(term) < 9 else 2


class Lexicon:
    """The trie of weighted terms, and the words already looked up by this worker."""

    def __init__(self, terms: dict[str, float]):
        self.weights = terms
        self.root: dict = {}
        self.most = max(map(errors_for, terms), default=0)
        for t in terms:
            node = self.root
            for c in t.removesuffix("*"):
                node = node.setdefault(c, {})
            node[""] = t
        self.longest = max(map(len, terms), default=0) + self.most  # a longer word can only begin with a stem
        self.stems = sorted({len(t) - 1 for t in terms if t.endswith("*")})
        # a word within e errors of a term holds one of the term's e+1 parts
        parts = {t[len(t) * i // (k + 1) : len(t) * (i + 1) // (k + 1)] for x in terms for k, t in [(errors_for(x), x.removesuffix("*"))] for i in range(k + 1)}
        self.part = re.compile("|".join(map(re.escape, sorted(parts)))) if parts else re.compile("(?!)")
        self.clean: set[str] = set()
        self.hits: dict[str, tuple[str, int]] = {}

    def walk(self, word: str) -> tuple[str, int] | None:
        """(term, errors) of the nearest term within its allowance."""
        at = {c: sum(1 << i for i, x in enumerate(word) if x == c) for c in set(word)}
        full = (1 << len(word) + 1) - 1
        start = [(1 << e + 1) - 1 & full for e in range(self.most + 1)]  # e characters of the word skipped
        best, todo = None, [(self.root, start)]
        while todo:
            node, rows = todo.pop()
            for c, child in node.items():
                if c == "":
                    e = next((e for e, r in enumerate(rows) if (r if child.endswith("*") else r >> len(word) & 1)), None)
                    if e is not None and e <= errors_for(child) and (best is None or (e, child) < (best[1], best[0])):
                        best = (child, e)
                    continue
                mask, new = at.get(c, 0), []
                for e, r in enumerate(rows):
                    n = (r & mask) << 1  # the same character
                    if e:
                        n |= rows[e - 1] | rows[e - 1] << 1 | new[e - 1] << 1  # one more, another, one less
                    new.append(n & full)
                if any(new):
                    todo.append((child, new))
        return best

    def nearest(self, word: str) -> tuple[str, int] | None:
        """walk for a word of any length that holds a part of a term."""
        if not word or not self.part.search(word):
            return None
        if len(word) <= self.longest:
            return self.walk(word)
        return next(((s, 0) for s in (word[:n] + "*" for n in self.stems) if s in self.weights), None)

    def of_token(self, token: str) -> tuple[str, int] | None:
        core = _STRIP.sub("", token)
        runs = [] if core.isalnum() else [r for r in _RUNS.findall(core) if r != core]
        return min(filter(None, map(self.nearest, [core, *runs])), key=lambda h: (h[1], h[0]), default=None)

    def look(self, words: list[str]) -> dict[str, tuple[str, int]]:
        """The words that hit, with their terms."""
        distinct = set(words)
        for w in distinct.difference(self.clean).difference(self.hits):
            hit = self.of_token(w)
            if hit:
                self.hits[w] = hit
            else:
                self.clean.add(w)
        found = {w: self.hits[w] for w in distinct.intersection(self.hits)}
        for kept in (self.clean, self.hits):
            if len(kept) > CACHE_WORDS:
                kept.clear()
        return found


def context(words: list[str], i: int) -> tuple[bool, bool]:
    """(quotation, second person) in the window around word i."""
    near = words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW]
    left = sum(w[:1] in MARKS for w in words[max(0, i - WINDOW) : i + 1]) > 0
    right = sum(w.rstrip(".,;:!?")[-1:] in MARKS for w in words[i : i + 1 + WINDOW] if w.rstrip(".,;:!?")) > 0
    cores = {_STRIP.sub("", w) for w in near}
    return (left and right) or not cores.isdisjoint(REPORTS), not cores.isdisjoint(PERSONS)


def features(text: str | None, lexicon: Lexicon) -> tuple[np.ndarray, list[tuple[int, str, int, bool]]]:
    """Counts of the kinds of hits on a log scale, and the hits: (word number, term, errors, quotation)."""
    words = (text or "").lower().split()
    found = lexicon.look(words)
    if not found:
        return np.zeros(KINDS), []
    n, hits, telling = np.zeros(KINDS), [], set()
    for i, w in enumerate(words):
        if w in found:
            term, e = found[w]
            quoted, person = context(words, i)
            strong = lexicon.weights[term] >= STRONG
            n[2 if quoted else 6 if not strong else 1 if e else 0] += 1
            n[3] += person and not quoted
            hits.append((i, term, e, quoted))
            if not quoted:
                telling.add(term)
    n[4] = 100 * len(hits) / len(words)
    n[5] = sum(lexicon.weights[t] >= STRONG for t in telling)
    n[7] = max(0.0, sum(lexicon.weights[t] for t in telling))
    return np.log1p(n), hits


def items_of(text: str | None) -> dict[str, set[str]]:
    """Candidate terms of a text: its words, and its words' beginnings ("lowei*") with the words they begin."""
    out: dict[str, set[str]] = {}
    for w in set(_WORD.findall((text or "").lower())):
        out[w] = {w}
        for n in STEMS:
            if len(w) > n:
                out.setdefault(w[:n] + "*", set()).add(w)
    return out


def _counted(rows: DataFrame, wanted: frozenset[str] | None = None) -> DataFrame:
    """(item, docs, words): rows that hold each item, and up to STEM_WORDS of an item's words. Counted by partition first."""

    def work(batches):
        docs, words = Counter(), {}
        for b in batches:
            for t in b["text"].to_pylist():
                for item, of in items_of(t).items():
                    if wanted is None or item in wanted:
                        docs[item] += 1
                        if len(have := words.setdefault(item, set())) < STEM_WORDS:
                            have |= of
        keys = sorted(docs)
        yield pa.RecordBatch.from_pydict({"item": pa.array(keys, pa.string()), "docs": pa.array([docs[k] for k in keys], pa.int64()), "words": pa.array([sorted(words[k])[:STEM_WORDS] for k in keys], pa.list_(pa.string()))})

    found = rows.select("text").mapInArrow(work, "item string, docs long, words array<string>").groupBy("item")
    return found.agg(F.sum("docs").alias("docs"), F.size(F.array_distinct(F.flatten(F.collect_list("words")))).alias("words"))


def learn_terms(texts: DataFrame, rows: int = LEXICON_ROWS) -> dict[str, float]:
    """Weights (log odds) of terms and stems ("lowei*") from (doc_id, text, label) that tell toxic rows, of a bounded sample of distinct texts.

    A term must be in enough toxic rows, mostly in toxic rows, and more often there than chance
    gives among so many candidates; a stem must also begin several different words.
    """
    sample = staged(bounded(texts.filter("label = 1"), rows).unionByName(bounded(texts.filter("label = 0"), rows)).dropDuplicates(["text"]), "lexicon-rows")
    size = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return {}
    least = max(LEAST_ROWS, TERM_SHARE * toxic)
    bad = {r["item"]: r["docs"] for r in _counted(sample.filter("label = 1")).filter((F.col("docs") >= least) & (~F.endswith("item", F.lit("*")) | (F.col("words") >= STEM_WORDS))).collect()}
    good = {r["item"]: r["docs"] for r in _counted(sample.filter("label = 0"), frozenset(bad)).collect()}
    base, found = toxic / (toxic + clean), []
    for item, k in bad.items():
        n = k + good.get(item, 0)
        p = k / n
        gain = n * (p * np.log(p / base) + ((1 - p) * np.log((1 - p) / (1 - base)) if p < 1 else 0))
        if p >= max(TERM_PURITY, 2 * base) and gain >= TERM_GAIN and (item.endswith("*") or k >= WORD_SHARE * toxic):
            found.append((-round(gain, 6), item.endswith("*"), -len(item), item, float(np.log((k + 0.5) / (n - k + 0.5)))))
    # of items that contain one another the most telling stays
    kept: dict[str, float] = {}
    for *_, item, weight in sorted(found):
        if not any(item.startswith(s.removesuffix("*")) or s.startswith(item.removesuffix("*")) for s in kept if s.endswith("*") or item.endswith("*")):
            kept[item] = weight
    return kept


def fit(train: DataFrame, steps: int = 8, ridge: float = 0.5) -> np.ndarray:
    """Logistic weights (intercept first) from (x, label) by Newton steps."""
    m = KINDS + 1
    w = np.zeros(m)
    for _ in range(steps):

        def newton(x, y, w=w):
            f = np.hstack([np.ones((len(x), 1)), x])
            p = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
            return np.concatenate([((f * (p * (1 - p))[:, None]).T @ f).ravel(), f.T @ (y - p), [len(y), y.sum()]])

        s = summed(train, KINDS, m * m + m + 2, newton)
        if not 0 < s[-1] < s[-2]:  # no rows, or of one class alone
            return np.array(PLAIN_WEIGHTS)
        penalty = np.full(m, ridge)
        penalty[0] = 1e-3
        move = np.linalg.solve(s[: m * m].reshape(m, m) + np.diag(penalty), s[m * m : -2] - penalty * w)
        w = w + np.clip(move, -4, 4)
        if np.abs(move).max() < 1e-3:
            break
    return w


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", held_out: Column | None = None, threshold: float = 0.3, terms=TERMS, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """(doc_id, held_out, score, predicted, terms found outside quotation) for each row of docs; rows that held_out (over doc_id) marks teach nothing.

    With ``keep`` the whole row comes along as struct ``row``, so that no join has to fetch it again.
    """
    small_batches(docs.sparkSession)
    held = F.lit(False) if held_out is None else held_out
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = unique_labels(labels, label).filter(~held)  # held-out labels have no part in anything below
    some = bounded(known.filter("label = 1"), LEXICON_ROWS).unionByName(bounded(known.filter("label = 0"), LEXICON_ROWS))  # bounded: can be broadcast
    terms = learn_terms(texts.join(F.broadcast(some), "doc_id")) | dict.fromkeys(terms, GIVEN)

    place = docs.columns.index(text_col)

    def work(batches):
        release()
        lexicon = Lexicon(terms)
        for b in batches:
            got = [features(t.as_py(), lexicon) for t in (b["row"].field(place) if keep else b["text"])]
            flat = pa.array(np.concatenate([x for x, _ in got]) if got else np.empty(0))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1, dtype=np.int32) * KINDS), flat)
            said = pa.array([sorted({t for _, t, _, q in h if not q}) for _, h in got], pa.list_(pa.string()))
            row = ([b["row"]], ["row"]) if keep else ([], [])
            yield pa.RecordBatch.from_arrays([b["doc_id"], lists, said, *row[0]], ["doc_id", "x", "terms", *row[1]])

    schema = T.StructType().add("doc_id", T.LongType()).add("x", T.ArrayType(T.DoubleType())).add("terms", T.ArrayType(T.StringType()))
    if keep:
        whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        x = staged(whole.mapInArrow(work, schema.add(whole.schema["row"])), "toxicity")
    else:
        x = staged(texts.mapInArrow(work, schema), "toxicity")
    w = fit(x.join(known, "doc_id").select("x", "label"))
    z = F.lit(float(w[0]))
    for i in range(KINDS):
        z = z + F.col("x")[i] * float(w[i + 1])
    score = 1 / (1 + F.exp(-z))
    return x.select("doc_id", held.alias("held_out"), score.alias("score"), (score >= threshold).cast("int").alias("predicted"), "terms", *(["row"] if keep else []))


def keep_clean(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, threshold: float = 0.3, id_col: str = "doc_id") -> DataFrame:
    """docs without the rows that are predicted toxic."""
    return classify(docs, labels, held_out=held_out, threshold=threshold, id_col=id_col, keep=True).filter("predicted = 0").select("row.*")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic", crc_mod(F.col("doc_id"), 4) == 2).select("doc_id", "held_out", "score", "predicted")
