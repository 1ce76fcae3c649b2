"""A quality classifier from weak labels.

Heuristic labellers look at each text and vote bad or abstain, since the absence of one fault is no merit; people's
labels, where there are some, are one more labeller of given reliability. Votes are counted by pattern over all documents, and
expectation-maximisation over those counts estimates each heuristic's accuracies and the share of bad texts. The posteriors label a bounded sample of
documents, on which a linear scorer over hashed words and shape features is trained; it judges every document. There is
one such model for quality and one for toxicity, and a document is kept that both accept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import stage, word_hashes

#: The scorer is fitted on at most this many documents.
SAMPLE_ROWS = 10_000
#: Features that enter the scorer.
MOST_FEATURES = 4_000
HASH_BITS = 18
#: Weights are summed in whole parts of this size, so that their order does not matter.
UNIT = 1 << 20
#: Besides whole words, their first bytes are features: words are too rare to be learned one by one.
PREFIXES = (4, 5, 6, 7)
#: Weight of a document without a person's label in the fit.
UNLABELLED_WEIGHT = 0.2
#: How often a person's label is taken to be right.
PERSON_RELIABILITY = 0.995
TASKS = ("quality", "toxic")
#: A document is rejected from these probabilities on; clean documents lie far below.
REJECT = {"quality": 0.3, "toxic": 0.4}
GOOD, ABSTAIN, BAD = 0, 1, 2

#: No heuristic is taken to see more than this share of the bad texts: people find what it has no words for.
MAX_COVERAGE = 0.6

# Words of abuse by kind, one toxicity labeller each.
ABUSE = [
    ["idiot", "idiots", "moron", "morons", "clown", "clowns", "loser", "losers", "scum", "fool", "jerk"],
    ["stupid", "worthless", "pathetic", "trash", "garbage", "disgusting", "dumb", "hate", "shut"],
]

_MARKS = np.zeros(256, bool)
_MARKS[[ord(c) for c in "!#$%&*|@^~<>{}[]=+\\"]] = True


def shape(text: str, own: np.ndarray) -> list[float]:
    """Of a text and its word hashes: odd marks a word, upper case among letters, digits, mean word length, repeated lines, bars a word, size, repeated words."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, len(raw))
    upper, lower = int(((raw >= 65) & (raw <= 90)).sum()), int((((raw >= 97) & (raw <= 122)) | (raw >= 128)).sum())
    spaces = int((raw == 32).sum() + (raw == 10).sum())
    lines = [x for x in text.split("\n") if x.strip()]
    words = max(1, spaces + 1)
    return [
        float(_MARKS[raw].sum()) / words,
        upper / max(1, upper + lower),
        float(((raw >= 48) & (raw <= 57)).sum()) / n,
        (n - spaces) / words,
        1 - len(set(lines)) / max(1, len(lines)),
        float((raw == 124).sum()) / words,
        float(np.log2(len(raw) + 1)),
        float((own[1:] == own[:-1]).mean()) if len(own) > 1 else 0.0,
    ]


def votes(text: str, own: np.ndarray, abuse: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """The votes of the quality and of the toxicity labellers on a text."""
    marks, upper, digits, length, repeated, bars, _, again = shape(text, own)
    words = len(own)

    faults = [
        marks >= 0.5,
        upper >= 0.3,
        bars >= 0.2,
        digits >= 0.3,
        repeated >= 0.5,
        again >= 0.4,
        length > 15 or words < 3,
    ]
    quality = [BAD if f else ABSTAIN for f in faults]
    # A text without a listed word may be abusive in other words: no vote.
    toxic = [BAD if np.isin(own, kind).any() else ABSTAIN for kind in abuse]
    return quality, toxic


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, prior: float, rounds: int = 60) -> tuple[np.ndarray, float, np.ndarray]:
    """Expectation-maximisation over counted vote patterns (rows of votes).

    The last column are people's votes, whose reliability is given. Returns p(vote | class) by class, labeller and vote, the share of the bad
    class, and the posterior of bad by pattern. Labellers are taken to err independently.
    """
    k, sure = patterns.shape[1], PERSON_RELIABILITY
    given = np.tile(np.array([[0.01, 0.96, 0.03], [0.01, 0.69, 0.3]])[:, None, :], (1, k, 1))
    given[:, -1] = [[sure, 1, 1 - sure], [1 - sure, 1, sure]]  # whether a person looked says nothing
    weight = counts / max(1.0, counts.sum())
    posterior = np.full(len(patterns), prior)
    for _ in range(rounds):
        log = np.stack([np.log([1 - prior, prior][c]) + sum(np.log(given[c, i, patterns[:, i]]) for i in range(k)) for c in (0, 1)])
        posterior = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        for c, mass in enumerate((weight * (1 - posterior), weight * posterior)):
            for i in range(k - 1):
                seen = np.bincount(patterns[:, i], mass, minlength=3) + 1e-4
                given[c, i] = seen / seen.sum()
        seen = given[1, :-1, BAD]
        over = seen > MAX_COVERAGE
        given[1, :-1, ABSTAIN] += np.where(over, seen - MAX_COVERAGE, 0)
        given[1, :-1, BAD] = np.where(over, MAX_COVERAGE, seen)
        prior = float(np.clip((weight * posterior).sum(), 1e-3, 0.5))
    return given, prior, posterior


def _features(words: np.ndarray, heads: np.ndarray, text: str) -> np.ndarray:
    """Distinct hashed places of a text's words and of their first bytes, and of its binned shape."""
    places = np.unique(np.concatenate([words, heads.ravel()]) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
    bins = [i * 32 + min(31, int(x)) for i, x in enumerate(np.multiply(shape(text, words), [8, 25, 25, 1, 10, 10, 1, 25]))]
    return np.append(places, (1 << HASH_BITS) + np.array(bins))


FEATURES = (1 << HASH_BITS) + 8 * 32


def telling(seen: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Which features enter the scorer, from the weight of the documents and of the bad ones they are in; the last sum is of all documents.

    Only the features that tell most by a chi-square test enter: the others, millions of rare words, would drown them.
    """
    share = float(np.clip(bad[-1] / max(seen[-1], 1e-9), 1e-3, 1 - 1e-3))
    seen, bad = seen[:-1], bad[:-1]
    tells = (bad - seen * share) ** 2 / np.maximum(seen * share * (1 - share), 1e-9)
    tells[seen < 5] = 0
    chosen = np.zeros(FEATURES, bool)
    chosen[np.argsort(-tells, kind="stable")[:MOST_FEATURES]] = True
    return chosen & (tells > 10)


def fit_scorer(rows: list[np.ndarray], target: np.ndarray, weight: np.ndarray, rounds: int = 20) -> np.ndarray:
    """Logistic regression on sparse binary features by adaptive gradient steps; the last weight is the bias."""
    w, square, rng = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-6), np.random.default_rng(7)
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            at = np.append(rows[i], FEATURES)
            error = weight[i] * (1 / (1 + np.exp(-np.clip(w[at].sum(), -30, 30))) - target[i])
            slope = error + 1e-4 * w[at]
            square[at] += slope * slope
            w[at] -= 0.1 * slope / np.sqrt(square[at])
    return w


def _abuse_hashes() -> list[np.ndarray]:
    return [word_hashes([" ".join(w + end for w in kind for end in ("", ".", ",", "!", "?"))])[0] for kind in ABUSE]


def vote_table(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Staged row_id, doc_id and the votes of all labellers, people's labels last; one row per document."""
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min(F.col("quality").cast("int")).alias("label_quality"), F.max(F.col("toxic").cast("int")).alias("label_toxic")
    )
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = docs.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("known"), "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        abuse = _abuse_hashes()
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                texts = [t if isinstance(t, str) else "" for t in part["text"]]
                words, counts = word_hashes(texts)
                found, b = [], 0
                for text, n in zip(texts, counts.tolist()):
                    found.append(votes(text, words[b : b + n], abuse))
                    b += n
                yield pd.DataFrame(
                    {"doc_id": part["doc_id"].to_numpy(), "known": part["known"].to_numpy(), "quality": [bytes(q) for q, _ in found], "toxic": [bytes(t) for _, t in found]}
                )

    voted = rows.mapInPandas(run, "doc_id long, known boolean, quality binary, toxic binary")
    voted = voted.select(F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), "quality", "toxic").join(marks, "doc_id", "left")
    person = [
        F.expr("case label_quality when 1 then 0 when 0 then 2 else 1 end").alias("quality_person"),
        F.expr("case label_toxic when 0 then 0 when 1 then 2 else 1 end").alias("toxic_person"),
    ]
    return stage(voted.select("doc_id", "quality", "toxic", *person), "votes")


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """For each task the labellers' accuracies, the share of bad texts and the scorer's weights.

    Counts of vote patterns cover all documents. The scorer's sample are the documents with the smallest hashes
    of their id: at most `sample_rows`, four fifths of them from those with a person's label.
    """
    table = vote_table(documents, labels)
    model: dict = {}
    for task in TASKS:
        rows = table.groupBy(task, f"{task}_person").count().collect()  # at most 3 to the number of labellers
        if not rows:
            model[task] = None
            continue
        patterns = np.array([[*r[task], r[f"{task}_person"]] for r in rows])
        counts = np.array([r["count"] for r in rows], float)
        given, share, posterior = fit_labellers(patterns, counts, 0.15)
        model[task] = {"given": given, "share": share, "posterior": {tuple(p): float(x) for p, x in zip(patterns.tolist(), posterior)}}
    people = [f"{t}_person" for t in TASKS]
    ids = table.where("doc_id is not null").groupBy("doc_id").agg(*[F.max(p).alias(p) for p in people])  # one per id anyway
    labelled = F.col("quality_person") + F.col("toxic_person") != 2 * ABSTAIN
    order = F.xxhash64("doc_id", F.lit(6))
    sample = ids.where(labelled).orderBy(order).limit(sample_rows * 4 // 5).union(ids.where(~labelled).orderBy(order).limit(sample_rows // 5))
    sample = F.broadcast(sample.withColumnsRenamed({p: f"__{p}" for p in people}))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Of repeated ids the smallest text; its votes are taken anew, since the ids' votes may be those of another.
    chosen = texts.join(sample, "doc_id").groupBy("doc_id", *[f"__{p}" for p in people]).agg(F.min("text").alias("text"))
    chosen = stage(chosen, "sample")
    fitted = {t: model[t]["posterior"] for t in TASKS if model[t] is not None}
    sums = _feature_sums(chosen, fitted)
    for task in TASKS:
        if task not in fitted or not sums[task][0][-1]:
            model[task] = None
    used = {t: telling(*sums[t]) for t in TASKS if model[t] is not None}
    if not used:
        return model
    either = np.any(list(used.values()), axis=0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, places, targets in _sampled(batches, fitted):
            out = {"doc_id": part["doc_id"].to_numpy(), "features": [p[either[p]].astype(np.int32).tobytes() for p in places]}
            for task in TASKS:
                out |= {f"{task}_target": targets[task][0] if task in targets else 0.0, f"{task}_weight": targets[task][1] if task in targets else 0.0}
            yield pd.DataFrame(out)

    schema = "doc_id long, features binary, " + ", ".join(f"{t}_target double, {t}_weight double" for t in TASKS)
    taken = chosen.mapInPandas(run, schema).collect()  # at most sample_rows, each with chosen features alone
    taken.sort(key=lambda r: r["doc_id"])
    rows = [np.frombuffer(r["features"], np.int32) for r in taken]
    for task, chosen_here in used.items():
        target, weight = (np.array([r[f"{task}_{x}"] for r in taken]) for x in ("target", "weight"))
        model[task]["weights"] = fit_scorer([r[chosen_here[r]] for r in rows], target, weight)
    return model


def _sampled(batches: Iterator[pd.DataFrame], fitted: dict[str, dict]) -> Iterator[tuple[pd.DataFrame, list[np.ndarray], dict[str, tuple[np.ndarray, np.ndarray]]]]:
    """Sampled documents with the features of their whole texts, and for each task targets and weights."""
    abuse = _abuse_hashes()
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.iloc[at : at + 256]
            texts = [t if isinstance(t, str) else "" for t in part["text"]]
            words, counts, heads = word_hashes(texts, PREFIXES)
            places, voted, b = [], [], 0
            for text, n in zip(texts, counts.tolist()):
                places.append(_features(words[b : b + n], heads[:, b : b + n], text))
                voted.append(dict(zip(TASKS, votes(text, words[b : b + n], abuse))))
                b += n
            targets = {}
            for task, posterior in fitted.items():
                person = part[f"__{task}_person"].to_numpy()
                target = np.array([posterior[(*v[task], p)] for v, p in zip(voted, person.tolist())])
                targets[task] = target, np.where(person == ABSTAIN, UNLABELLED_WEIGHT, 1.0)
            yield part, places, targets


def _feature_sums(chosen: DataFrame, fitted: dict[str, dict]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each task the weight of the sampled documents, and of the bad ones, by feature; last that of all."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((len(TASKS), 2, FEATURES + 1), np.int64)
        for _, places, targets in _sampled(batches, fitted):
            for k, task in enumerate(TASKS):
                if task in targets:
                    target, weight = targets[task]
                    for at, x, y in zip(places, np.rint(weight * UNIT).astype(int), np.rint(weight * target * UNIT).astype(int)):
                        sums[k, 0, at] += x
                        sums[k, 1, at] += y
                        sums[k, :, -1] += x, y
        for k in range(len(TASKS)):
            at = np.flatnonzero(sums[k, 0])
            yield pd.DataFrame({"task": k, "feature": at, "seen": sums[k, 0, at], "bad": sums[k, 1, at]})

    found = chosen.mapInPandas(run, "task int, feature int, seen long, bad long").groupBy("task", "feature").agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad"))
    table = found.toArrow()
    sums = np.zeros((len(TASKS), 2, FEATURES + 1))
    task, feature = table["task"].to_numpy(), table["feature"].to_numpy()
    for i, name in enumerate(("seen", "bad")):
        sums[task, i, feature] = table[name].to_numpy() / UNIT
    return {t: (sums[k, 0], sums[k, 1]) for k, t in enumerate(TASKS)}


def _weights(model: dict) -> dict[str, np.ndarray | None]:
    """The scorers' weights, 1 MB a task."""
    return {t: None if model[t] is None else model[t]["weights"].astype(np.float32) for t in TASKS}


def _probabilities(column: pd.Series, weights: dict[str, np.ndarray | None]) -> np.ndarray:
    """For each task the probability that a text is bad; a text without words is of bad quality."""
    p = np.zeros((len(TASKS), len(column)))
    for at in range(0, len(column), 256):
        texts = [t if isinstance(t, str) else "" for t in column.iloc[at : at + 256]]
        words, counts, heads = word_hashes(texts, PREFIXES)
        begin = 0
        for i, (text, n) in enumerate(zip(texts, counts.tolist()), at):
            places = _features(words[begin : begin + n], heads[:, begin : begin + n], text)
            for k, task in enumerate(TASKS):
                if n == 0:
                    p[k, i] = float(task == "quality")
                elif weights[task] is not None:
                    z = float(weights[task][places].sum(dtype=np.float64) + weights[task][-1])
                    p[k, i] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            begin += n
    return p


def judge(documents: DataFrame, model: dict) -> DataFrame:
    """doc_id, p_bad_quality, p_toxic, kept: one row per document, whole texts; kept if neither reaches `REJECT`."""
    weights = _weights(model)
    docs = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNotNull().alias("known"),
        F.col("text").cast("string").alias("text"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = _probabilities(batch["text"], weights)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "known": batch["known"], "p_bad_quality": p[0], "p_toxic": p[1]})

    out = docs.mapInPandas(run, "doc_id long, known boolean, p_bad_quality double, p_toxic double")
    kept = (F.col("p_bad_quality") < REJECT["quality"]) & (F.col("p_toxic") < REJECT["toxic"])
    return out.select(F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), "p_bad_quality", "p_toxic", kept.alias("kept"))


def classify(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """`judge` after `train` on the same documents (doc_id, text) and labels (doc_id, quality, toxic).

    Null, empty and blank texts are of bad quality. Repeated rows get the same verdict; null ids stay null and train nothing.
    Several labels of a document count as the worst. Without labels the heuristics alone vote; an empty table gives an empty
    result. Further columns are left out.
    """
    return judge(documents, train(documents, labels, sample_rows))


def keep_good(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that the classifier keeps, with all their columns, in one pass over the texts."""
    weights = _weights(train(documents, labels, sample_rows))

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        limits = np.array([[REJECT[t]] for t in TASKS])
        return pd.Series((_probabilities(texts, weights) < limits).all(axis=0))

    return documents.where(good(F.col("text").cast("string")))
