"""Languages of words and texts by a linear-chain conditional random field.

Each word has a label; its features are hashes of its first and last letters,
of its letter runs of three, and of the word itself (the lexicon), and
neighbouring labels meet in learned transitions. Forward-backward gives each
word's probabilities given its whole neighbourhood, so a text may switch
languages; the text's language has the largest mean share.

Training texts are labelled as a whole. To learn when to switch, short runs of
words from different texts are strung together by a seeded order. At most
`rows_per_language` labelled texts of each language are used, picked by hash,
and of each at most `words_per_row` words, in seeded runs from anywhere in its
text; both are parameters. The gradient of the log likelihood is computed by tasks over the stored sample and
added up; every step is a Spark job.

Prediction is a map over all texts and moves nothing. Texts of any length are
cut into lanes that overlap by `LAP` words on each side, enough for the chain
to forget what lies further off; features are looked up once for each distinct
word of a slice.

`language_runs` gives the runs of words of one language, from the same word
probabilities as the text's language and score.

Defined cases: a null text, or one without a letter, is `und` with score 0 and
has no runs; without training rows every text is; repeated rows are predicted alike; a
single learned language wins every text that has a letter; of equally probable
languages the first by name wins; very long texts are read in sequences of
bounded length; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..session import drop_stored, store
from .substrings import kept_texts
from .words import NON_SPACE, Words, combine, mix, slices

SLOTS = 1 << 16
ROWS_PER_LANGUAGE, WORDS_PER_ROW = 600, 400
#: Neighbouring words of a long training text that are drawn together.
RUN = 16
ROUNDS, RATE, PRIOR = 8, 0.5, 1e-3
LANE, LAP = 192, 16
SEQUENCE = 64
#: Tasks of a training step.
SAMPLE_TASKS = 8
UNKNOWN = "und"
#: Languages that one model may tell apart.
MOST_LANGUAGES = 512


def word_features(words: Words, rows: np.ndarray):
    """Slots of the features of some words of a slice, where each word's begin,
    and each feature's weight."""
    starts, ends = words.starts[rows], words.ends[rows]
    size = ends - starts
    data = np.concatenate([words.data, np.zeros(8, np.uint8)]).astype(np.uint64)
    sets, owners, shares = [], [], []

    def add(kind, value, at, share):
        sets.append((combine(value, np.full(len(value), kind, np.uint64)) % np.uint64(SLOTS)).astype(np.int64))
        owners.append(at)
        shares.append(share)

    every, one = np.arange(len(rows)), np.ones(len(rows))
    for k in (1, 2, 3):
        head, tail = np.zeros(len(rows), np.uint64), np.zeros(len(rows), np.uint64)
        for i in range(k):
            head |= np.where(size > i, data[starts + i], np.uint64(0)) << np.uint64(8 * i)
            tail |= np.where(size > i, data[np.maximum(ends - 1 - i, 0)], np.uint64(0)) << np.uint64(8 * i)
        add(k, head, every, one)
        add(10 + k, tail, every, one)
    lexicon = Words.hashes(words)[rows]
    add(20, lexicon, every, one)
    runs = np.maximum(size - 2, 0)
    at = np.repeat(every, runs)
    place = np.repeat(starts, runs) + np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    grams = data[place] | data[place + 1] << np.uint64(8) | data[place + 2] << np.uint64(16)
    add(30, grams, at, 1.0 / np.sqrt(np.maximum(runs, 1))[at])
    slot, owner, share = (np.concatenate(x) for x in (sets, owners, shares))
    return slot, owner, share


def emissions(words: Words, weights: np.ndarray):
    """Label scores of each word; equal words are looked up once."""
    h = words.hashes()
    _, rows, back = np.unique(h, return_index=True, return_inverse=True)
    slot, owner, share = word_features(words, rows)
    out = np.stack([np.bincount(owner, weights[slot, k] * share, len(rows)) for k in range(weights.shape[1])], 1)
    return out.reshape(len(rows), -1)[back]


def forward_backward(scores: np.ndarray, move: np.ndarray, valid: np.ndarray):
    """Label probabilities of each place of equally long sequences, and the
    expected transitions between neighbours. `valid`: places that have a word;
    they stand at the front."""
    n, length, k = scores.shape
    local = np.exp(scores - scores.max(2, keepdims=True))
    local[~valid] = 1.0
    step = np.exp(move - move.max())
    ahead, back = np.empty_like(local), np.ones_like(local)
    ahead[:, 0] = local[:, 0] / local[:, 0].sum(1, keepdims=True)
    for t in range(1, length):
        a = (ahead[:, t - 1] @ step) * local[:, t]
        a = np.where(valid[:, t, None], a, ahead[:, t - 1])
        ahead[:, t] = a / a.sum(1, keepdims=True)
    for t in range(length - 2, -1, -1):
        b = (back[:, t + 1] * local[:, t + 1]) @ step.T
        b = np.where(valid[:, t + 1, None], b, back[:, t + 1])
        back[:, t] = b / b.sum(1, keepdims=True)
    share = ahead * back
    share /= share.sum(2, keepdims=True)
    return share, ahead, back, local, step


def _drawn(words: Words, draws: np.ndarray, limit: int) -> np.ndarray:
    """Words to learn from: all of a text of at most `limit` words, else so many
    in runs of `RUN` drawn from the whole text by its own seed."""
    keep = np.ones(len(words), bool)
    for t in np.flatnonzero(words.counts() > limit):
        i, n = int(words.first[t]), int(words.counts()[t])
        mine, left = np.zeros(n, bool), limit
        for r in np.random.default_rng(int(draws[t]) & 0x7FFFFFFF).permutation(-(-n // RUN)):
            if not left:
                break
            size = min(RUN, n - int(r) * RUN, left)
            mine[int(r) * RUN : int(r) * RUN + size] = True
            left -= size
        keep[i : i + n] = mine
    return keep


def _draw_words(limit):
    def run(batches):
        for batch in batches:
            column, draws = batch.column("text"), batch.column("draw").to_numpy(zero_copy_only=False)
            for start, stop in slices(column):
                words = Words(column.slice(start, stop - start), NON_SPACE)
                ends, data = kept_texts(words, _drawn(words, draws[start:stop], limit))
                texts = [data[i : max(i, j - 1)].decode("utf-8", "replace") for i, j in zip([0, *ends[:-1].tolist()], ends.tolist())]
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.string()), part.column("label"), part.column("draw")], ["text", "label", "draw"])

    return run


def _train_sequences(ids, words, labels, n_labels):
    """Runs of words of different texts strung together: word numbers and labels
    (sequences x SEQUENCE; -1 where there is none)."""
    rng = np.random.default_rng(int(ids.sum() & 0x7FFFFFFF))
    runs = []
    for t, (i, j) in enumerate(zip(words.first[:-1], words.first[1:])):
        while i < j:
            size = int(rng.integers(4, SEQUENCE))
            runs.append((i, min(i + size, j), labels[t]))
            i += size
    order = rng.permutation(len(runs))
    at = np.concatenate([np.arange(*runs[r][:2]) for r in order]) if len(runs) else np.zeros(0, np.int64)
    label = np.concatenate([np.full(runs[r][1] - runs[r][0], runs[r][2]) for r in order]) if len(runs) else np.zeros(0, np.int64)
    rows = -(-len(at) // SEQUENCE)
    pad = rows * SEQUENCE - len(at)
    shape = lambda x: np.concatenate([x, np.full(pad, -1)]).astype(np.int64).reshape(rows, SEQUENCE)
    return shape(at), shape(label)


def _gradient(sent, n_labels):
    """The sample's gradient of the log likelihood: features and transitions."""

    def run(batches):
        weights, move = sent.value
        lean, lean_move = np.zeros((SLOTS, n_labels)), np.zeros((n_labels, n_labels))
        for batch in batches:
            for start, stop in slices(batch.column("text")):
                words = Words(batch.column("text").slice(start, stop - start), NON_SPACE, lower=True)
                ids = batch.column("draw").slice(start, stop - start).to_numpy(zero_copy_only=False)
                labels = batch.column("label").slice(start, stop - start).to_numpy(zero_copy_only=False)
                at, label = _train_sequences(ids, words, labels, n_labels)
                if not len(at):
                    continue
                valid = at >= 0
                scores = emissions(words, weights)[at]
                share, ahead, back, local, step = forward_backward(scores, move, valid)
                rest = -share
                rest[valid, label[valid]] += 1
                both = valid[:, 1:]
                for t in range(1, SEQUENCE):
                    before, after = ahead[both[:, t - 1], t - 1], (local[:, t] * back[:, t])[both[:, t - 1]]
                    norm = ((before @ step) * after).sum(1, keepdims=True)
                    lean_move -= step * (before.T @ (after / norm))
                    np.add.at(lean_move, (label[both[:, t - 1], t - 1], label[both[:, t - 1], t]), 1)
                rows = np.unique(at[valid])
                slot, owner, weight = word_features(words, rows)
                back_of = np.zeros(len(words), np.int64)
                back_of[rows] = np.arange(len(rows))
                summed = np.zeros((len(rows), n_labels))
                np.add.at(summed, back_of[at[valid]], rest[valid])
                for k in range(n_labels):
                    lean[:, k] += np.bincount(slot, summed[owner, k] * weight, SLOTS)
        some = np.flatnonzero(np.abs(lean).sum(1))
        yield pa.RecordBatch.from_arrays([
            pa.array([some.astype("<i4").tobytes()], pa.binary()), pa.array([lean[some].astype(np.float32).tobytes()], pa.binary()),
            pa.array([lean_move.tobytes()], pa.binary())], ["slots", "lean", "move"])

    return run


def train(sample: DataFrame, n_labels: int, rounds: int = ROUNDS):
    """Weights and transitions from a stored sample: text, label, draw."""
    spark = sample.sparkSession
    weights, move = np.zeros((SLOTS, n_labels)), np.zeros((n_labels, n_labels))
    past, past_move = np.full_like(weights, 1e-6), np.full_like(move, 1e-6)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((weights.astype(np.float32), move))
        lean, lean_move = -PRIOR * weights, np.zeros_like(move)
        for row in sample.mapInArrow(_gradient(sent, n_labels), "slots binary, lean binary, move binary").toLocalIterator():
            lean[np.frombuffer(row["slots"], "<i4")] += np.frombuffer(row["lean"], np.float32).reshape(-1, n_labels)
            lean_move += np.frombuffer(row["move"]).reshape(n_labels, n_labels)
        sent.unpersist()
        past += lean**2
        past_move += lean_move**2
        weights += RATE * lean / np.sqrt(past)
        move += RATE * lean_move / np.sqrt(past_move)
    return weights.astype(np.float32), move


def text_shares(words: Words, weights, move):
    """Mean label probabilities of each text's words; each word's likeliest
    label and its probability."""
    n, k = len(words.first) - 1, move.shape[0]
    total, best, sure = np.zeros((n, k)), np.zeros(len(words), np.int64), np.zeros(len(words))
    if not len(words):
        return total, best, sure
    scores = emissions(words, weights)
    count = words.counts()
    lanes = -(-count // LANE)
    text = np.repeat(np.arange(n), lanes)
    begin = words.first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * LANE
    end = np.minimum(begin + LANE, words.first[text + 1])
    low = np.maximum(begin - LAP, words.first[text])
    high = np.minimum(end + LAP, words.first[text + 1])
    for some in np.array_split(np.arange(len(text)), -(-len(text) // 2048)):
        size = high[some] - low[some]
        at = low[some][:, None] + np.arange(size.max())
        valid = at < high[some][:, None]
        share = forward_backward(scores[np.minimum(at, len(scores) - 1)], move, valid)[0]
        own = (at >= begin[some][:, None]) & (at < end[some][:, None])
        best[at[own]], sure[at[own]] = share[own].argmax(1), share[own].max(1)
        share[~own] = 0
        np.add.at(total, text[some], share.sum(1))
    return total / np.maximum(count, 1)[:, None], best, sure


def _runs(words: Words, best, sure, lettered, names):
    """For each text the runs of words of one label, with their mean
    probability; none for texts that have no letter."""
    owner = words.owners()
    new = np.ones(len(best), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (best[1:] != best[:-1])
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(best)))
    mean = np.add.reduceat(sure, head) / size if len(head) else np.zeros(0)
    some = lettered[owner[head]]
    head, size, mean = head[some], size[some], mean[some]
    start = head - words.first[owner[head]]
    ends = np.searchsorted(owner[head], np.arange(len(words.first)))
    fields = [pa.array(start, pa.int64()), pa.array(start + size, pa.int64()),
              pa.array(names[best[head]], pa.string()), pa.array(np.clip(mean, 0, 1))]
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "end", "language", "probability"]))


_PREDICTED = "doc_id bigint, held_out boolean, lang_pred string, score double"
_RUNS = "array<struct<start: bigint, end: bigint, language: string, probability: double>>"


def _predict(sent, with_runs):
    def run(batches):
        names, weights, move = sent.value
        for batch in batches:
            column = batch.column("text")
            lettered = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            best, score, runs = [], [], []
            names_of = np.array([*names, UNKNOWN], object)
            for start, stop in slices(column):
                if not names:
                    best.append(np.zeros(stop - start, np.int64))
                    score.append(np.zeros(stop - start))
                    continue
                words = Words(column.slice(start, stop - start), NON_SPACE, lower=True)
                share, *of_words = text_shares(words, weights, move)
                if with_runs:
                    runs.append(_runs(words, *of_words, lettered[start:stop], names_of))
                best.append(share.argmax(1))
                score.append(share.max(1))
            best, score = (np.concatenate(x) if x else np.zeros(0) for x in (best, score))
            some = lettered if names else np.zeros(len(lettered), bool)
            out = [batch.column("doc_id"), batch.column("held_out"),
                   pa.array(names_of[np.where(some, best, len(names)).astype(np.int64)], pa.string()),
                   pa.array(np.where(some, np.clip(score, 0, 1), 0.0))]
            if with_runs:
                if not runs:
                    none = Words(pa.array([""] * len(lettered), pa.string()))
                    runs = [_runs(none, np.zeros(0, np.int64), np.zeros(0), lettered, names_of)]
                out.append(pa.concat_arrays(runs))
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "held_out", "lang_pred", "score", "runs"][: len(out)])

    return run


def identify(docs: DataFrame, held_out, id: str = "doc_id", text: str = "text", lang: str = "lang",
             rows_per_language: int = ROWS_PER_LANGUAGE, rounds: int = ROUNDS, words_per_row: int = WORDS_PER_ROW) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document. It learns from
    rows with a text and a language for which `held_out` is false."""
    model = _learned(docs, held_out, id, text, lang, rows_per_language, rounds, words_per_row)
    return _predicted(docs, held_out, id, text, model, False)


def language_runs(docs: DataFrame, held_out, id: str = "doc_id", text: str = "text", lang: str = "lang",
                  rows_per_language: int = ROWS_PER_LANGUAGE, rounds: int = ROUNDS, words_per_row: int = WORDS_PER_ROW) -> DataFrame:
    """doc_id, start, end, language and probability: runs of words of one
    language, as whitespace cuts the text, from word `start` (the first is 0)
    to before word `end`, and the words' mean probability. Learned as by
    `identify`."""
    model = _learned(docs, held_out, id, text, lang, rows_per_language, rounds, words_per_row)
    rows = _predicted(docs, held_out, id, text, model, True)
    return rows.select("doc_id", F.explode("runs").alias("run")).select("doc_id", "run.*")


def _learned(docs, held_out, id, text, lang, rows_per_language, rounds, words_per_row):
    """Languages, weights and transitions."""
    spark = docs.sparkSession
    known = docs.where(~held_out & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(id), F.col(text)).alias("draw"))
    counts = dict(known.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect())
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    names = sorted(counts)
    model = ([], None, None)
    if names:
        pick = F.lit(False)
        for name in names:
            part = min(1.0, rows_per_language / counts[name])
            pick = pick | ((F.col("lang") == name) & (F.pmod("draw", F.lit(1 << 30)) < int(part * (1 << 30))))
        number = F.array_position(F.array(*map(F.lit, names)), F.col("lang")) - 1
        # Only the words that are learned from travel.
        rows = known.where(pick).select("text", number.cast("bigint").alias("label"), "draw").mapInArrow(
            _draw_words(words_per_row), "text string, label bigint, draw bigint")
        sample, path = store(rows.repartition(SAMPLE_TASKS), "sample")
        model = (names, *train(sample, len(names), rounds))
        drop_stored(spark, path)
    return model


def _predicted(docs, held_out, id, text, model, with_runs):
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"))
    return rows.mapInArrow(_predict(sent, with_runs), _PREDICTED + (f", runs {_RUNS}" if with_runs else ""))


def language_report(docs: DataFrame) -> DataFrame:
    """Trained on documents whose crc32(doc_id as text) mod 3 is not 1."""
    return identify(docs, F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)))
