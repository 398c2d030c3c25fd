"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.batches import small_batches
from flowsieve.llm.words import Words, chunks, letters, mix, powers, prefix_sums, slices
from flowsieve.session import lookup_join, written

PREFIXES = (4, 5, 6, 7)
#: Places of the table that leads from a feature to its number.
_TABLE_BITS = 20
#: Texts are worked on in pieces of about this many bytes: two workers of an executor hold such a piece, many times over.
_CHUNK = 1 << 18
#: Vote patterns that the label model spreads out at a time.
_BLOCK = 1 << 16


def features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, parent) of every word and of its first bytes: a stem tells more than its many endings.

    The parent is the next shorter beginning, 0 if there is none.
    """
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    raw = np.frombuffer(words.data, np.uint8)
    total, inverse = prefix_sums(raw), powers(len(raw))[1]
    owner, size = words.owner(), words.end - words.start
    last = np.zeros(len(words), np.uint64)  # the longest beginning so far
    owners, out, parents = [], [], []
    for k in PREFIXES:
        long = np.flatnonzero(size > k)
        start = words.start[long]
        owners.append(owner[long])
        out.append(mix((total[start + k] - total[start]) * inverse[start] + np.uint64(k)))
        parents.append(last[long])
        last[long] = out[-1]
    return tuple(np.concatenate(x) for x in ([*owners, owner], [*out, words.hash], [*parents, last]))


class Table:
    """Number of each chosen feature."""

    def __init__(self, chosen: np.ndarray):
        self.key = np.zeros(1 << _TABLE_BITS, np.uint64)
        self.number = np.full(1 << _TABLE_BITS, -1, np.int32)
        slot = (chosen >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)[::-1]
        self.key[slot], self.number[slot] = chosen[::-1], np.arange(len(chosen))[::-1]  # the better one wins a clash
        self.size = len(chosen)

    def present(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(text, number, times) of the chosen features in each text."""
        owner, feature, _ = features(words)
        slot = (feature >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        hit = np.flatnonzero((self.key[slot] == feature) & (self.number[slot] >= 0))
        pair, times = np.unique(owner[hit] * self.size + self.number[slot[hit]], return_counts=True)
        return pair // max(self.size, 1), pair % max(self.size, 1), times


def steps(number: np.ndarray, times: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, input) of the classifier's inputs: one per feature for being there, one for twice, one for four times."""
    rows = [np.flatnonzero(times >= least) for least in (1, 2, 4)]
    return np.concatenate(rows), np.concatenate([number[r] + k * size for k, r in enumerate(rows)])


#: Patterns that may go with abuse; the label model finds out which do.
PATTERNS = {
    "shouting": lambda t: sum(c.isupper() for c in t) > 0.5 * max(1, sum(c.isalpha() for c in t)),
    "exclaiming": lambda t: t.count("!") >= 3 and t.count("!") > len(t) / 200,
    "masked": lambda t: any(m in t for m in ("***", "###", "$$$", "%%%")),
    "repeating": lambda t: len(w := t.split()) >= 20 and len(set(w)) < 0.3 * len(w),
    "brief": lambda t: len(t) < 80,
}


def label_model(votes: np.ndarray, anchor: int, rounds: int = 60, times: np.ndarray | None = None) -> tuple[np.ndarray, dict]:
    """Posterior probability of class 1 per row, and what was estimated, from votes in {-1, 0, 1}.

    Row k stands for ``times[k]`` documents (one without ``times``). The first guess follows the voter ``anchor`` where
    it does not abstain, so that class 1 means what that voter means, but its errors are
    estimated like those of the others. Every voter has a probability of each vote under each class; these and the class share come from expectation-
    maximisation over all rows. Voters that agree beyond what the class explains are correlated: after each fit, a voter's
    evidence is divided by the sum of its conditional correlations, so that a clique counts about once.
    """
    n, m = votes.shape
    times = np.ones(n) if times is None else np.asarray(times, float)
    blocks = [slice(k, k + _BLOCK) for k in range(0, n, _BLOCK)]
    weight, table = np.ones(m), np.empty((2, m, 3))

    def hot(at: slice) -> np.ndarray:
        return np.stack([(votes[at] == v).astype(float) for v in (-1, 0, 1)], axis=2).reshape(-1, 3 * m)

    rate = (sum(times[at] @ hot(at) for at in blocks) / times.sum()).reshape(m, 3)
    post = np.where(votes[:, anchor] > 0, 0.95, 0.05)

    def learn(times: np.ndarray) -> float:
        for y, p in ((0, times * (1 - post)), (1, times * post)):
            seen = sum(p[at] @ hot(at) for at in blocks).reshape(m, 3)
            table[y] = (seen + 0.5 * rate + 0.01) / (p.sum() + 0.5 + 0.03)
        return float(np.clip((times @ post) / times.sum(), 0.01, 0.5))

    told = times * (votes[:, anchor] != 0)
    share = learn(told if told.any() else times)
    table[:, anchor, 1] = max(rate[anchor, 1], 1e-6)  # whether a row is labelled tells nothing at first
    for turn in range(rounds):
        for at in blocks:
            score = hot(at) @ (np.log(table) * weight[:, None]).reshape(2, -1).T + np.log([1 - share, share])
            post[at] = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -50, 50)))
        share = learn(times)
        if turn % 20 == 19:
            together = np.zeros((m, m))
            for p in (times * (1 - post), times * post):
                mean = sum(p[at] @ votes[at] for at in blocks) / max(p.sum(), 1e-9)
                off = (votes[at] - mean for at in blocks)
                cov = sum((o * p[at, None]).T @ o for o, at in zip(off, blocks, strict=True)) / max(p.sum(), 1e-9)
                sd = np.sqrt(np.diag(cov)) + 1e-9
                together += (0.5 * cov) / sd[:, None] / sd[None, :]
            np.fill_diagonal(together, 1)
            weight = 1 / np.maximum(1, np.where(together > 0.1, together, 0).sum(1))
    return post, {"share": share, "votes": table, "weight": weight}


def pattern(votes: np.ndarray) -> np.ndarray:
    """One number per row of votes in {-1, 0, 1}."""
    return (votes + 1) @ 3 ** np.arange(votes.shape[1], dtype=np.int64)


def unpattern(code: np.ndarray, voters: int) -> np.ndarray:
    """The votes that ``pattern`` made the numbers from."""
    return np.stack([(code // 3**k % 3 - 1).astype(np.int8) for k in range(voters)], axis=1)


def unlike(words: Words) -> np.ndarray:
    """One of 64 bits per text, by the least hash of its five-word runs: copies and most near copies have the same."""
    out = np.zeros(len(words.first) - 1, np.uint64)
    owner, run = words.shingles(5)
    if len(owner):
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        out[owner[first]] = np.uint64(1) << (mix(np.minimum.reduceat(run, first)) >> np.uint64(58))
    return out


class Model:
    """Chosen features with their weights; scores texts inside the tasks."""

    def __init__(self, table: Table, weights: np.ndarray, intercept: float):
        self.table, self.weights, self.intercept = table, weights, intercept

    def score(self, texts: list) -> np.ndarray:
        words = [letters(t) for t in texts]
        out = np.full(len(words), self.intercept)
        for i, j in chunks(words, _CHUNK):
            text, number, times = self.table.present(Words(words[i:j]))
            row, place = steps(number, times, self.table.size)
            out[i:j] += np.bincount(text[row], self.weights[place], j - i)
        return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def _fold(id_col: str, folds: int = 3) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(folds))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    fold: int = 1,
    max_labelled: int = 30_000,
    lexicons: int = 16,
    entries: int = 512,
    support: int = 5,
) -> Model:
    """Train on the documents outside the held-out fold.

    Features are counted over all labelled ones. They must occur in ``support`` documents, most of them unlike each
    other (see ``unlike``): copies of a few documents must not make an entry. Words and word
    beginnings that go with label 1 are dealt to ``lexicons`` voters by rank, so that none depends
    on one entry; each votes 1 when a text has one of its entries. Two voters count all entries: they vote 1 from two
    or four on and 0 without any. The patterns vote 1, and the label itself is a voter whose errors are estimated like the others'; it abstains where there is no label. All
    documents vote, labelled or not, and the label model learns from the counts of the vote patterns. The classifier
    is a logistic regression on the features with the label model's posteriors as weights of both classes. Only for it
    about ``max_labelled`` labelled documents are drawn by hash, half of them with label 1 if there are so many;
    what is drawn counts for what is not.
    """
    from pyspark.ml.classification import LogisticRegression  # here, as workers import this module but never fit
    from pyspark.ml.feature import CountVectorizerModel

    if lexicons + len(PATTERNS) + 3 > 39:
        raise ValueError("a vote pattern must fit into 63 bits")
    small_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label"))
    known = known.dropna().groupBy("label_id").agg(F.max("label").alias("label")).filter(_fold("label_id") != fold)
    known = known.filter("label IN (0, 1)")
    texts = docs.select(F.col(id_col).alias("label_id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.filter(_fold("label_id") != fold)
    labelled = lookup_join(texts, known, "label_id").filter("label IS NOT NULL").select("label_id", "text", "label")
    shares = {r.label: r.n for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = shares.get(0, 0), shares.get(1, 0)
    if not n0 or not n1:
        return Model(Table(np.zeros(0, np.uint64)), np.zeros(0), 30.0 if n1 else -30.0)

    def count(batches):
        for batch in slices(batches, 0, 4 * _CHUNK):
            words = [letters(t) for t in batch.column(0).to_pylist()]
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j in chunks(words, _CHUNK):
                found = Words(words[i:j])
                owner, feature, parent = features(found)
                bit = unlike(found)
                order = np.lexsort((owner, feature))
                owner, feature, parent = owner[order], feature[order], parent[order]
                new = np.ones(len(order), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (feature[1:] != feature[:-1])
                value, first, where = np.unique(feature[new], return_index=True, return_inverse=True)
                ones = np.bincount(where, label[i:j][owner[new]], len(value)).astype(np.int64)
                every = np.bincount(where, minlength=len(value))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(x)
                        for x in (
                            value.view(np.int64),
                            parent[new][first].view(np.int64),
                            ones,
                            every,
                            np.bitwise_or.reduceat(bit[owner[new]], first).view(np.int64) if len(first) else ones,
                        )
                    ],
                    names=["feature", "parent", "a", "n", "bits"],
                )

    a, b = F.col("a"), F.col("n") - F.col("a")
    odds = F.log((a + 0.5) / (n1 - a + 0.5)) - F.log((b + 0.5) / (n0 - b + 0.5))
    # at least this large, by two standard errors: a frequent but weak feature ranks below a rare but sure one
    sure = F.abs(odds) - 2 * F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    counted = labelled.select("text", "label").mapInArrow(count, "feature long, parent long, a long, n long, bits long")
    chosen = (
        counted.groupBy("feature")
        .agg(F.max("parent").alias("parent"), F.sum("a").alias("a"), F.sum("n").alias("n"), F.bit_or("bits").alias("bits"))
        .filter(F.col("n") >= support)
        .filter(F.bit_count("bits") >= int(np.ceil(64 * (1 - np.exp(-0.75 * support / 64)))))
        .select("feature", "parent", "n", sure.alias("sure"), odds.alias("odds"))
        .filter("sure > 1.5")
        .orderBy(F.desc("sure"), "feature")
        .limit(16 * entries)
        .toPandas()
    )
    # a beginning that hardly ever goes on in another way says the same as its continuation, and is dropped
    many = dict(zip(chosen.feature, chosen.n, strict=True))
    same = {p for p, n in zip(chosen.parent, chosen.n, strict=True) if n >= 0.9 * many.get(p, np.inf)}
    chosen = chosen[~chosen.feature.isin(same)].head(4 * entries).reset_index(drop=True)
    table = Table(chosen.feature.to_numpy().view(np.uint64))
    best = np.flatnonzero((chosen.odds > 0).to_numpy())[:entries]
    if not table.size:  # too few labels to tell any feature from chance: every text has the share of label 1
        return Model(table, np.zeros(0), float(np.log(n1 / n0)))
    # entries with a common beginning are one family: they must not count as several witnesses
    parent, family = dict(zip(chosen.feature, chosen.parent, strict=True)), np.full(len(chosen), -1)
    roots: dict[int, int] = {}
    for k in best:
        root = int(chosen.feature[k])
        while parent.get(root, 0) in parent:
            root = int(parent[root])
        family[k] = roots.setdefault(root, len(roots))
    voter = np.where(family >= 0, family % lexicons, -1)
    shared = docs.sparkSession.sparkContext.broadcast((table, voter, family))

    def vote(batches):
        table, voter, family = shared.value
        for batch in slices(batches, 1, 4 * _CHUNK):
            texts, drawn = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            words, codes, numbers = [letters(t) for t in texts], [], []
            for i, j in chunks(words, _CHUNK):
                text, number, times = table.present(Words(words[i:j]))
                votes = np.zeros((j - i, lexicons), np.int64)
                says = voter[number] >= 0
                votes[text[says], voter[number[says]]] = 1
                most = np.zeros((j - i, int(family.max(initial=0)) + 1), np.int64)
                np.maximum.at(most, (text[says], family[number[says]]), times[says])
                hits = most.sum(1)
                two, four = ((hits >= k).astype(np.int64) - (hits == 0) for k in (2, 4))
                shape = np.array([[int(p(t or "")) for p in PATTERNS.values()] for t in texts[i:j]], np.int64)
                codes.append(pattern(np.column_stack([votes, two, four, shape])))
                row, place = steps(number, times, table.size)
                order = np.argsort(text[row], kind="stable")
                split = np.split(place[order], np.searchsorted(text[row][order], np.arange(1, j - i)))
                numbers += [[str(k) for k in x] if d else None for x, d in zip(split, drawn[i:j], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(codes)), pa.array(numbers, pa.list_(pa.string()))],
                names=["label_id", "code", "numbers"],
            )

    ones = min(n1, max(max_labelled // 2, max_labelled - n0))
    part = {y: min(1_000_000, int(np.ceil(k / n * 1_000_000))) for y, k, n in ((0, max_labelled - ones, n0), (1, ones, n1))}
    cut = F.when(F.col("label") == 1, part[1]).otherwise(part[0])
    drawn = known.filter(F.pmod(F.xxhash64("label_id"), F.lit(1_000_000)) < cut)  # bounded by max_labelled
    drawn = F.broadcast(drawn.select("label_id", F.lit(True).alias("drawn")))
    kind = dict(texts.dtypes)["label_id"]
    voters = lexicons + 2 + len(PATTERNS) + 1
    voted = texts.join(drawn, "label_id", "left").select("label_id", "text", "drawn")
    voted = written(voted.mapInArrow(vote, f"label_id {kind}, code long, numbers array<string>"), "votes")
    label_vote = F.coalesce(2 * F.col("label"), F.lit(1)) * F.lit(3 ** (voters - 1))  # without a label it abstains
    voted = lookup_join(voted, known, "label_id").withColumn("code", F.col("code") + label_vote)
    kinds = voted.groupBy("code").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("code")
    post, _ = label_model(unpattern(kinds.code.to_numpy(), voters), -1, times=kinds.n.to_numpy())
    voted = voted.filter("numbers IS NOT NULL")
    used = voted.select("code").distinct().toPandas().code.to_numpy()  # at most max_labelled rows
    posterior = docs.sparkSession.createDataFrame(  # of Python rows, executors would start more workers
        pa.table([pa.array(used, pa.int64()), pa.array(post[np.searchsorted(kinds.code.to_numpy(), used)])], names=["code", "p"])
    )
    counter = CountVectorizerModel.from_vocabulary(
        [str(k) for k in range(3 * table.size)], inputCol="numbers", outputCol="features", minTF=1
    )
    both = F.array(
        *(F.struct(F.lit(y).alias("label"), p.alias("weight")) for y, p in ((1.0, F.col("p")), (0.0, 1 - F.col("p"))))
    )
    counts_for = F.when(F.col("drawn_label") == 1, 1_000_000 / part[1]).otherwise(1_000_000 / part[0])
    rows = voted.withColumnRenamed("label", "drawn_label").join(F.broadcast(posterior), "code")
    rows = rows.select("numbers", counts_for.alias("counts_for"), F.explode(both).alias("e")).filter("e.weight > 0.001")
    rows = counter.transform(rows.select("numbers", "e.label", (F.col("e.weight") * F.col("counts_for")).alias("weight")))
    fitted = LogisticRegression(weightCol="weight", regParam=1e-5, maxIter=100, standardization=False).fit(rows)
    return Model(table, fitted.coefficients.toArray(), float(fitted.intercept))


def score_texts(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", fold: int = 1, threshold: float = 0.7
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted. Only the text is scored; an empty one has the
    score of a text without any known feature."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches, 2, 4 * _CHUNK):
            score = shared.value.score(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (_fold(id_col) == fold).alias("held"), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns.

    Whole rows go through the workers that scored before, as those of a column function would stay beside them.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in slices(batches, at, 4 * _CHUNK):
            yield batch.filter(pa.array(shared.value.score(batch.column(at).to_pylist()) < threshold))

    text = F.col(f"`{text_col}`").cast("string")
    return docs.withColumn(text_col, text).mapInArrow(run, docs.withColumn(text_col, text).schema)
