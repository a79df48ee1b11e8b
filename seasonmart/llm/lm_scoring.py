"""Operator 2: documents scored by masked pseudo-likelihood."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonmart.llm.common import bound_batches, fresh, held, text_or_empty, with_columns
from seasonmart.llm.masked_model import CLASSES, FREQUENT, RARE, MaskedModel, Tokens, text_scores, train
from seasonmart.llm.pieces import strings
from seasonmart.sources.sinks import stage

#: Rounds of training. Each learns from its share of the documents, then models are averaged.
ROUNDS = 4
#: Different words a task counts before it hands them on, and numbers of a model in one row.
COUNTED, SLICE = 300_000, 2048
#: Different words and tokens from which a chunk of documents is closed.
CHUNK_WORDS, CHUNK_TOKENS = 200_000, 2_000_000


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, as ``str.split`` finds them, and how many each text has; null counts as empty."""
    cut = pc.utf8_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    words, sizes = cut.flatten(), pc.list_value_length(cut).to_numpy()
    blank = pc.equal(words, "").to_numpy(zero_copy_only=False)  # white space at a text's ends
    if blank.any():
        sizes = sizes - np.bincount(np.repeat(np.arange(len(sizes)), sizes)[blank], minlength=len(sizes))
        words = words.filter(pa.array(~blank))
    return words, sizes


def _add_up(counts: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(counts).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return found.select(["word", "n_sum"]).rename_columns(["word", "n"])


def _count_words(batches):
    counts, different = [], 0
    for batch in batches:
        found = split_words(batch.column(0))[0].value_counts()
        counts.append(pa.table({"word": found.field("values").cast(pa.string()), "n": found.field("counts")}))
        different += len(found)
        if different > 2 * COUNTED:
            counts = [_add_up(counts)]
            different = counts[0].num_rows
        if different > COUNTED and len(counts) == 1:
            yield from counts[0].to_batches()
            counts, different = [], 0
    if counts:
        yield from _add_up(counts).to_batches()


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """How often each word occurs in all documents: word, n. Tasks add up what they read first."""
    texts = docs.select(text_or_empty(text).alias("text"))
    counted = texts.mapInArrow(_count_words, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame) -> list[str]:
    """The most frequent words, as many as have classes of their own."""
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT)
    return [row.word for row in top.collect()]


def vocabulary(docs: DataFrame, text: str = "text") -> list[str]:
    return most_frequent(word_counts(docs, text))


def class_weights(counts: DataFrame, words: list[str]) -> np.ndarray:
    """For each class the logarithm of its tokens and one more for unseen words; 0 for a word's own class."""
    shared = F.pmod(F.crc32(F.right("word", F.lit(2)).cast("binary")), F.lit(RARE))  # as in Tokens
    sums = counts.where(~F.col("word").isin(words)).groupBy(shared.alias("class")).agg(F.sum("n").alias("n"))
    weights = np.zeros(CLASSES)
    for row in sums.collect():
        weights[FREQUENT + row["class"]] = np.log(row.n + 1)
    return weights


def _tokens(words: tuple[str, ...]) -> Tokens:
    return held(("tokens", words), lambda: Tokens(list(words)))


def _groups(batches, tokens: Tokens):
    for batch in batches:
        if batch.num_rows:
            words, sizes = split_words(batch.column(0))
            different = words.dictionary_encode()
            classes = np.frombuffer(tokens.classes(strings(different.dictionary)), np.uint8)
            line, ends = classes[different.indices.to_numpy()].tobytes(), np.cumsum(sizes).tolist()
            yield [line[a:b] for a, b in zip([0, *ends], ends)]


def _model_rows(tokens: int, numbers: np.ndarray, slices: list[int]) -> pa.RecordBatch:
    parts = [numbers[i * SLICE : (i + 1) * SLICE].tobytes() for i in range(len(slices))]
    columns = [pa.array(slices, pa.int32()), pa.array([tokens] * len(slices), pa.int64()), pa.array(parts, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["slice", "tokens", "numbers"])


def _train_local(words, values):
    def run(batches):
        trained, tokens = train(MaskedModel.from_flat(values.value), _groups(batches, _tokens(words.value)))
        if tokens:
            numbers = trained.flat().astype(np.float32)
            yield _model_rows(tokens, numbers, list(range(-(-len(numbers) // SLICE))))

    return run


LOCAL_MODEL = "slice int, tokens long, numbers binary"


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The average of one slice of all tasks' models by their tokens, one after the other."""
    at, tokens, total = 0, 0, np.zeros(1)
    for batch in batches:
        for at, n, part in zip(*(column.to_pylist() for column in batch.columns)):
            tokens, total = tokens + n, total + n * np.frombuffer(part, np.float32).astype(np.float64)
    yield _model_rows(tokens, (total / tokens).astype(np.float32), [at])


def fit_model(docs: DataFrame, words: list[str], text: str = "text", rounds: int = ROUNDS) -> MaskedModel:
    """Train on every token of every document, once.

    In each round every task learns from its documents of that round, starting from the model so
    far; the results are averaged by their number of tokens. Documents are divided over rounds by
    a hash of their text. Only models (some 20,000 numbers per task) are shuffled, in slices that
    are added up as a stream.
    """
    context = docs.sparkSession.sparkContext
    texts = docs.select(text_or_empty(text).alias("text"))
    shared_words = context.broadcast(tuple(words))
    model = MaskedModel.start()
    for turn in range(rounds):
        values = context.broadcast(model.flat())
        share = texts.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == turn)
        local = share.mapInArrow(_train_local(shared_words, values), LOCAL_MODEL)
        found = local.groupBy("slice").applyInArrow(_average, LOCAL_MODEL).collect()
        if found:
            parts = {r.slice: np.frombuffer(bytes(r.numbers), np.float32) for r in found}
            model = MaskedModel.from_flat(np.concatenate([parts[i] for i in sorted(parts)]))
    return model


def with_log_probability(
    docs: DataFrame, words: list[str], model: MaskedModel, text: str = "text"
) -> DataFrame:
    """Add ``n_tokens`` and ``log_prob``, the sum over a text's tokens of their classes' log-probabilities.

    Null counts as empty. What a word has within its class is left out; see ``token_scores``.

    Where a name is taken, the new column's gets an underscore in front.
    """
    n_tokens, log_prob = (fresh(docs.columns, name) for name in ("n_tokens", "log_prob"))
    context = docs.sparkSession.sparkContext
    shared_words, values = context.broadcast(tuple(words)), context.broadcast(model.flat())

    def run(batches):
        tokens, found = _tokens(shared_words.value), MaskedModel.from_flat(values.value)
        for batch in batches:
            texts = [tokens.of("" if t is None else t) for t in batch.column(text).to_pylist()]
            scores = text_scores(found, texts) if texts else np.zeros(0)
            yield batch.append_column(n_tokens, pa.array([len(t) for t in texts], pa.int64())).append_column(
                log_prob, pa.array(scores, pa.float64())
            )

    return docs.mapInArrow(run, with_columns(docs, {n_tokens: "long", log_prob: "double"}))


class _Places(dict):
    """The place of each word among the different words of a chunk, and the words' classes by place."""

    def __init__(self, tokens: Tokens):
        super().__init__()
        self.tokens, self.classes = tokens, bytearray()

    def of(self, texts: pa.Array) -> list[np.ndarray]:
        """The places of each text's words."""
        words, sizes = split_words(texts)
        words = words.dictionary_encode()
        different = strings(words.dictionary)
        places = list(map(self.get, different))
        missing = [i for i, place in enumerate(places) if place is None]
        new = [different[i] for i in missing]
        for i, place in zip(missing, range(len(self), len(self) + len(new))):
            places[i] = place
        self.update(zip(new, range(len(self), len(self) + len(new))))
        self.classes += self.tokens.classes(new)
        of_words = np.array(places, np.int32)[words.indices.to_numpy()]
        return np.split(of_words, np.cumsum(sizes)[:-1])


CHUNK_ROWS = "chunk long, place int, word string, n_tokens long, log_prob double, places binary"


def _chunk_rows(words, values, weights):
    """Per document its classes' part of the score and the places of its words; per chunk its words."""

    def run(batches):
        tokens, model = _tokens(words.value), MaskedModel.from_flat(values.value)

        def rows(size, ids, **columns):
            kinds = {"chunk": pa.int64(), "place": pa.int32(), "word": pa.string(), "n_tokens": pa.int64(),
                     "log_prob": pa.float64(), "places": pa.binary()}
            columns["chunk"] = [chunk] * size
            found = {k: pa.array(columns[k], t) if k in columns else pa.nulls(size, t) for k, t in kinds.items()}
            return pa.RecordBatch.from_pydict({**found, "doc_id": ids})

        def chunk_words():
            rare = np.flatnonzero(np.frombuffer(bytes(known.classes), np.uint8) >= FREQUENT)
            names = list(known)
            return rows(len(rare), pa.nulls(len(rare), kind), place=rare.astype(np.int32), word=[names[i] for i in rare])

        known, seen, chunk, kind = _Places(tokens), 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if not seen:
                # The rows are staged, so that a chunk's number is drawn once.
                chunk, kind = int.from_bytes(os.urandom(8), "big", signed=True), batch.column("doc_id").type
            places = known.of(batch.column("text"))
            classes = np.frombuffer(bytes(known.classes), np.uint8)
            own = [classes[p] for p in places]
            scores = text_scores(model, [c.tobytes() for c in own]) - [weights.value[c].sum() for c in own]
            rare = [p[c >= FREQUENT].tobytes() for p, c in zip(places, own)]
            yield rows(len(own), batch.column("doc_id"), n_tokens=[len(p) for p in places], log_prob=scores, places=rare)
            seen += 1 + sum(map(len, places))
            if len(known) >= CHUNK_WORDS or seen >= CHUNK_TOKENS:
                yield chunk_words()
                known, seen = _Places(tokens), 0
        if known:
            yield chunk_words()

    return run


def _add_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The scores of one chunk's documents, with what each of their words has within its class."""
    docs, places, logs = [], [np.zeros(0, np.int32)], [np.zeros(0)]
    for batch in batches:
        is_word = pc.is_valid(batch.column("place"))
        found = batch.filter(is_word)
        places.append(found.column("place").to_numpy(zero_copy_only=False))
        logs.append(found.column("log_prob").to_numpy(zero_copy_only=False))
        docs.append(batch.filter(pc.invert(is_word)))
    at = np.concatenate(places)
    by_place = np.zeros(at.max(initial=-1) + 1)
    by_place[at] = np.concatenate(logs)
    for batch in docs:
        if batch.num_rows:
            within = [by_place[np.frombuffer(p, np.int32)].sum() for p in batch.column("places").to_pylist()]
            scores = batch.column("log_prob").to_numpy(zero_copy_only=False) + within
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_tokens": batch.column("n_tokens"), "log_prob": pa.array(scores),
            })


def token_scores(docs: DataFrame, words: list[str], model: MaskedModel, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens and log_prob of ``docs`` (doc_id, text): each token's class times its word in the class.

    A word's probability in a shared class is its share of the class's tokens in ``counts`` (word,
    n), where all unseen words together count as one token more. Counts are joined to the
    different words of a chunk of documents, so that neither texts nor single tokens are shuffled
    with them and a hot word has one row a chunk.
    """
    context = docs.sparkSession.sparkContext
    shared_words, values = context.broadcast(tuple(words)), context.broadcast(model.flat())
    weights = context.broadcast(class_weights(counts, words))
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    chunks = docs.select("doc_id", "text").mapInArrow(
        _chunk_rows(shared_words, values, weights), f"{CHUNK_ROWS}, doc_id {doc_id}"
    )
    chunks = stage(chunks, "lm_chunks")
    in_class = F.log(F.coalesce("n", F.lit(1)).cast("double"))
    found = chunks.where("place is not null").join(counts, "word", "left")
    parts = found.select("chunk", "place", in_class.alias("log_prob")).unionByName(
        chunks.where("place is null").drop("word", "place"), allowMissingColumns=True
    )
    return parts.groupBy("chunk").applyInArrow(_add_words, f"doc_id {doc_id}, n_tokens long, log_prob double")


def lm_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, log_prob, mean_log_prob.

    Tokens are words between white space; the most frequent words of all documents have classes
    of their own, the others share ``RARE`` classes by their last letters. A small network, trained
    in numpy on all documents, predicts each token's class from the classes on both sides of it;
    within a class a word has its share of the class's tokens in all documents. The
    pseudo-likelihood of a text is the sum of log P(class | both sides) + log P(word | class).

    Defined results: null and empty texts have 0 tokens, log_prob 0 and a null mean. Repeated rows
    score alike, up to the rounding of single precision. Words of equal frequency enter the
    vocabulary in the order of their letters. Texts of any length are scored whole, and are learned
    from whole. An empty table gives an empty result. Other columns are left out.

    Tasks learn apart and are averaged, so scores depend a little on how the table is partitioned.
    """
    bound_batches(docs.sparkSession)
    counts = stage(word_counts(docs, text), "word_counts")
    words = most_frequent(counts)
    model = fit_model(docs, words, text)
    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return token_scores(thin, words, model, counts).select(
        "doc_id", "n_tokens", "log_prob",
        F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")).alias("mean_log_prob"),
    )
