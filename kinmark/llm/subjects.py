"""Subject areas of documents by classifier chains with calibrated beam decoding.

1. Terms.  The language is told by function words, and each language has its
   own terms.  A document is cut into sentences; every sentence is about one of
   the subjects or about none.  From the labelled documents alone, expectation
   maximisation learns the words of each subject and of the background: a
   sentence of a labelled document belongs to one of its subjects or to none,
   rarely (``STRAY``) to another.
2. Features of a document: for each subject the expected number of its
   sentences, their share, and whether there is one or at least two of them;
   the sources and languages that the labelled documents have; structure (number of sentences, paragraphs, a
   heading, markup).
3. Chain.  Subject after subject, most frequent first, a logistic regression
   decides from the features and from the subjects decided before, so that
   co-occurrence counts.  Each link is calibrated (Platt scaling) on folds it
   was not fitted on.
4. Decoding.  A beam search over the chain finds the most probable combination
   of at most ``MOST`` subjects.

The model is fitted on at most ``MAX_LABELLED`` labelled documents (those of
the lowest hash of their id; a documented bound on the training sample only).
Scoring covers every document and its whole text, in one pass without a
shuffle.

Edge cases: NULL or empty texts have no subject; without any label no document
has one; repeated labels count once; labels of unknown documents or with NULL
codes are left out; labels disagreeing between readers are all kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LABELLED = 4_000
MOST = 3
BEAM = 6
STRAY = 0.02
FOLDS = 8
PRIOR_WORDS = 300.0
LEAST_DOCS = 2  # labelled documents that hold a word
_SENTENCE = re.compile(r"(?<=[^\W\d_A-Z][^\w\s])\s+|(?<=[\d)])[.!?]\s+|(?<=[a-zß-ÿ])[.!?]\s+|\n+")
_WORD = re.compile(r"[^\W\d_]{2,}")
_TAG = re.compile(r"<[^<>]{0,200}>")
_HEADING = re.compile(r"^\s*(?:=+ .* =+|[^.\n]{3,60})\n")
#: A source or language is a feature of its own if at least so many labelled documents have it.
LEAST_BEARERS = 5


#: Function words by which the language of a document is told.
FUNCTION_WORDS = {
    "eng": "the and of in at by to was were from with his her he she for on an",
    "deu": "der die das und in von zu den mit ein eine im aus sich wurde auf des nach war bis",
    "fra": "le la les et de des du en un une à dans par sur au aux est fut pour qui",
    "spa": "el la los las y de del en un una con por para se al su es fue que como",
}
_TONGUES = list(FUNCTION_WORDS)
_FUNCTION = {t: frozenset(w.split()) for t, w in FUNCTION_WORDS.items()}


def tongue(doc: list[list[str]]) -> int:
    """Number of the language whose function words are most frequent; 0 where none is."""
    head = [w for s in doc for w in s]
    counts = [sum(w in f for w in head) for f in _FUNCTION.values()]
    return counts.index(max(counts))


def sentences(text: str) -> list[list[str]]:
    """Words in lower case of each sentence; markup removed."""
    bare = _TAG.sub("\n", text) if "<" in text else text
    out = [_WORD.findall(s.lower()) for s in _SENTENCE.split(bare) if s]
    return [w for w in out if w]


def code(lang: str | None) -> str:
    """The first two letters of a language's code or name."""
    return (lang or "")[:2].lower()


def structure(text: str, source: str | None, lang: str | None, n_sentences: int, kinds: tuple[list[str], list[str]]) -> list[float]:
    """Structure, source and language of a document; ``kinds`` are the sources and languages that have a feature."""
    paragraphs = text.count("\n") + 1
    out = [np.log1p(n_sentences), np.log1p(len(text)) / 5, np.log1p(paragraphs), float(bool(_HEADING.match(text))), float("<" in text)]
    out += [float(source == s) for s in kinds[0]]
    return out + [float(code(lang) == x) for x in kinds[1]]


def kinds_of(rows: list[tuple[str, str | None, str | None, list[str]]]) -> tuple[list[str], list[str]]:
    """Sources and languages that enough of the labelled documents have."""
    often = lambda values: sorted(v for v, n in Counter(values).items() if v and n >= LEAST_BEARERS)
    return often(r[1] for r in rows), often(code(r[2]) for r in rows)


@dataclass
class TermModel:
    """Of each language: its words, and the log probability of each word in each subject and, last, in the background."""

    words: list[dict[str, int]]
    logp: list[np.ndarray]  # words x (subjects + 1)
    prior: list[np.ndarray]  # log share of sentences


def _flatten(docs: list[list[list[str]]], words: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ids, start of each sentence, document of each sentence; sentences without a known word are left out."""
    ids: list[int] = []
    starts: list[int] = []
    owner: list[int] = []
    get = words.get
    for n, doc in enumerate(docs):
        for s in doc:
            known = [i for i in map(get, s) if i is not None]
            if known:
                starts.append(len(ids))
                owner.append(n)
                ids += known
    return np.asarray(ids, dtype=np.int32), np.asarray(starts, dtype=np.int64), np.asarray(owner, dtype=np.int64)


def _posterior(scores: np.ndarray) -> np.ndarray:
    p = np.exp(scores - scores.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def fit_terms(docs: list[list[list[str]]], labels: np.ndarray, rounds: int = 8) -> TermModel:
    """Words of each subject in each language by expectation maximisation over labelled documents."""
    own = np.array([tongue(d) for d in docs])
    out = TermModel([], [], [])
    for t in range(len(_TONGUES)):
        of = np.flatnonzero(own == t)
        words, logp, prior = _fit_language([docs[i] for i in of], labels[of], rounds)
        out.words.append(words)
        out.logp.append(logp.astype(np.float32))
        out.prior.append(prior.astype(np.float32))
    return out


def _fit_language(docs: list[list[list[str]]], labels: np.ndarray, rounds: int) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    count: dict[str, int] = {}
    for doc in docs:
        for w in {w for s in doc for w in s}:
            count[w] = count.get(w, 0) + 1
    words = {w: i for i, w in enumerate(sorted(w for w, n in count.items() if n >= LEAST_DOCS))}
    k = labels.shape[1]
    ids, starts, owner = _flatten(docs, words)
    weight = np.full((len(docs), k + 1), STRAY)
    weight[:, :k][labels > 0] = 1.0
    weight[:, k] = 1.0
    weight /= weight.sum(axis=1, keepdims=True)
    if not len(starts):
        return {}, np.zeros((1, k + 1)), np.zeros(k + 1)
    lengths = np.diff(np.append(starts, len(ids)))
    sentence_of = np.repeat(np.arange(len(starts)), lengths)
    post = weight[owner]
    overall = (np.bincount(ids, minlength=len(words)) / len(ids))[:, None]
    logp = np.zeros((len(words), k + 1))
    for n in range(rounds):
        mass = np.stack([np.bincount(ids, weights=post[sentence_of, j], minlength=len(words)) for j in range(k + 1)], axis=1)
        if n == 0:
            # a word spread evenly over all subjects belongs to the background: start from how far each word leans
            own = mass[:, :k] / np.maximum(mass[:, :k].sum(axis=0, keepdims=True), 1e-9)
            lean = own.max(axis=1) / np.maximum(own.sum(axis=1), 1e-12)
            mass[:, :k] *= np.clip(lean[:, None] * 2 - 0.4, 0.05, 1)
            mass[:, k] *= np.clip(1.4 - lean * 2, 0.05, 1)
        # smoothed with the words of all sentences, so that an unseen word speaks for no subject
        logp = np.log((mass + PRIOR_WORDS * overall) / (mass.sum(axis=0, keepdims=True) + PRIOR_WORDS))
        post = _posterior(np.add.reduceat(logp[ids], starts, axis=0) + np.log(weight[owner]))
    return words, logp, np.log((post.sum(axis=0) + 1) / (post.sum() + k + 1))


def evidence(model: TermModel, docs: list[list[list[str]]]) -> np.ndarray:
    """Expected number of sentences of each subject in each document."""
    k = model.logp[0].shape[1] - 1
    n = np.zeros((len(docs), k))
    own = np.array([tongue(d) for d in docs])
    for t in range(len(_TONGUES)):
        of = np.flatnonzero(own == t)
        ids, starts, owner = _flatten([docs[i] for i in of], model.words[t])
        if len(starts):
            post = _posterior(np.add.reduceat(model.logp[t][ids], starts, axis=0) + model.prior[t])
            for j in range(k):
                n[of, j] = np.bincount(owner, weights=post[:, j], minlength=len(of))
    return n


def features(n: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per subject (documents x subjects x features) and shared features."""
    lines = np.maximum(np.expm1(other[:, :1]), 1)  # sentences of the document
    total = n.sum(axis=1, keepdims=True)
    share = n / np.maximum(total, 0.5)
    top = n.max(axis=1, keepdims=True)
    near = np.clip((n / np.maximum(top, 0.5) - 0.25) / 0.3, 0, 1)  # comes near the foremost subject
    own = np.stack([near, near * np.clip(n / 2, 0, 1), np.log1p(n), share, np.clip(n, 0, 1), np.clip(n - 1, 0, 1), np.clip(n - 2, 0, 1), n / np.maximum(top, 0.5), np.minimum(n / lines, 1), np.clip(n, 0, 1) / lines], axis=2)
    return own, other


def _logistic(x: np.ndarray, y: np.ndarray, l2: float, centre: np.ndarray | None = None, rounds: int = 25) -> np.ndarray:
    """Newton's method with a ridge penalty towards ``centre``; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    centre = np.zeros(x.shape[1]) if centre is None else centre
    w = centre.copy()
    ridge = np.full(len(w), l2)
    ridge[-1] = l2 / 10
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * (w - centre)
        h = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, grad)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-4:
            break
    return w


@dataclass
class Chain:
    """Classifier chain with calibrated links."""

    order: list[int]
    weights: list[np.ndarray]
    platt: list[tuple[float, float]]

    def link(self, step: int, own: np.ndarray, shared: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Calibrated probability of the subject decided at ``step``."""
        x = _link_features(own, shared, before, self.order[step])
        w = self.weights[step]
        z = x @ w[:-1] + w[-1]
        a, b = self.platt[step]
        return 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))

    def decode(self, own: np.ndarray, shared: np.ndarray, beam: int = BEAM, most: int = MOST) -> np.ndarray:
        """Most probable combination of at most ``most`` subjects for each document."""
        n, k = own.shape[0], own.shape[1]
        state = np.zeros((n, 1, k))
        score = np.zeros((n, 1))
        for step, j in enumerate(self.order):
            width = state.shape[1]
            p = np.stack([self.link(step, own, shared, state[:, b]) for b in range(width)], axis=1)
            p = np.clip(p, 1e-9, 1 - 1e-9)
            yes = state.copy()
            yes[:, :, j] = 1
            full = state.sum(axis=2) >= most
            both = np.concatenate([score + np.log(1 - p), np.where(full, -np.inf, score + np.log(p))], axis=1)
            keep = np.argsort(-both, axis=1, kind="stable")[:, :beam]
            state = np.take_along_axis(np.concatenate([state, yes], axis=1), keep[:, :, None], axis=1)
            score = np.take_along_axis(both, keep, axis=1)
        return state[:, 0]


def _link_features(own: np.ndarray, shared: np.ndarray, before: np.ndarray, j: int) -> np.ndarray:
    others = np.delete(own[:, :, 2], j, axis=1)
    rivals = np.sort(others, axis=1)[:, ::-1][:, :3]
    if rivals.shape[1] < 3:
        rivals = np.pad(rivals, ((0, 0), (0, 3 - rivals.shape[1])))
    rank = (others > own[:, j, 2:3]).sum(axis=1, keepdims=True)
    ranks = np.hstack([rank == r for r in range(4)]) * own[:, j, 4:5]
    return np.hstack([own[:, j], rivals, ranks, shared, before, before.sum(axis=1, keepdims=True)])


def fit_chain(n: np.ndarray, other: np.ndarray, labels: np.ndarray, l2: float = 2.0) -> Chain:
    """Fit every link on all labelled documents, its calibration on held-out folds."""
    own, shared = features(n, other)
    order = [int(j) for j in np.argsort(-labels.sum(axis=0), kind="stable")]
    weights, platt = [], []
    fold = np.arange(len(labels)) % FOLDS
    before = np.zeros_like(labels)
    # what all links have in common, learnt from all of them; a link then departs from it as far as its labels say
    k = labels.shape[1]
    pooled_x = np.vstack([_link_features(own, shared, np.zeros_like(labels), j) for j in range(k)])
    centre = _logistic(pooled_x, labels.T.reshape(-1), l2)
    for j in order:
        x, y = _link_features(own, shared, before, j), labels[:, j]
        weights.append(_logistic(x, y, l2, centre))
        held = np.zeros(len(y))
        for f in range(FOLDS):
            w = _logistic(x[fold != f], y[fold != f], l2, centre)
            held[fold == f] = x[fold == f] @ w[:-1] + w[-1]
        a, b = _logistic(held[:, None], y, 1.0)
        platt.append((max(float(a), 0.2), float(b)))
        before = before.copy()
        before[:, j] = y
    return Chain(order, weights, platt)


@dataclass
class SubjectModel:
    """Codes, terms and chain."""

    codes: list[str]
    terms: TermModel
    chain: Chain | None
    kinds: tuple[list[str], list[str]] = ([], [])

    def predict(self, texts: list[str], sources: list[str | None], langs: list[str | None]) -> np.ndarray:
        """Documents x subjects, 1 where a document is mainly about it."""
        docs = [sentences(t) for t in texts]
        other = np.array([structure(t, s, g, len(d), self.kinds) for t, s, g, d in zip(texts, sources, langs, docs, strict=True)])
        n = evidence(self.terms, docs)
        own, shared = features(n, other)
        out = self.chain.decode(own, shared)
        out[n < 0.3] = 0  # no sentence of it at all
        return out


def fit(rows: list[tuple[str, str | None, str | None, list[str]]], codes: list[str]) -> SubjectModel:
    """Model from (text, source, lang, subject codes) of labelled documents."""
    at = {c: i for i, c in enumerate(codes)}
    docs = [sentences(r[0]) for r in rows]
    labels = np.zeros((len(rows), len(codes)))
    for i, r in enumerate(rows):
        for c in r[3]:
            labels[i, at[c]] = 1
    if not rows or not codes:
        return SubjectModel(codes, TermModel([], [], []), None)
    kinds = kinds_of(rows)
    other = np.array([structure(r[0], r[1], r[2], len(d), kinds) for r, d in zip(rows, docs, strict=True)])
    # evidence of labelled documents comes from folds, else it would look better than that of new documents
    n = np.zeros((len(rows), len(codes)))
    fold = np.arange(len(rows)) % FOLDS
    for f in range(FOLDS):
        held = np.flatnonzero(fold == f)
        rest = np.flatnonzero(fold != f)
        if len(held) and len(rest):
            n[held] = evidence(fit_terms([docs[i] for i in rest], labels[rest]), [docs[i] for i in held])
    return SubjectModel(codes, fit_terms(docs, labels), fit_chain(n, other, labels), kinds)


def labelled(docs: DataFrame, labels: DataFrame) -> list[tuple[str, str | None, str | None, list[str]]]:
    """The bounded training sample: (text, source, lang, codes) of labelled documents."""
    codes = labels.where("doc_id IS NOT NULL AND subject_code IS NOT NULL").groupBy("doc_id").agg(F.sort_array(F.collect_set("subject_code")).alias("codes"))
    some = codes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    joined = docs.where("text IS NOT NULL").select("doc_id", "text", "source", "lang").join(some, "doc_id")
    rows = joined.collect()  # at most MAX_LABELLED documents
    return [(r.text, r.source, r.lang, list(r.codes)) for r in sorted(rows, key=lambda r: r.doc_id)]


def assign(docs: DataFrame, model: SubjectModel) -> DataFrame:
    """doc_id, subject_code for every document and each subject it is mainly about."""
    out = "doc_id bigint, subject_code string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), 500):
                part = batch.iloc[a : a + 500]
                texts = list(part["text"])
                hit = model.predict(texts, list(part["source"]), list(part["lang"]))
                i, j = np.nonzero(hit)
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy()[i], "subject_code": [model.codes[x] for x in j]})

    texts = docs.where("text IS NOT NULL AND text <> ''").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", "lang")
    if model.chain is None:
        return texts.select("doc_id", F.lit(None).cast("string").alias("subject_code")).where("false")
    return texts.mapInPandas(run, out)
