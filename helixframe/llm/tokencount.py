"""Token counts of whole texts without token ids.

Three passes, of which only the first and the last read texts:

1. the distinct pre-tokens of all texts and how often each occurs, by grouped aggregation;
2. each distinct pre-token is counted once, by the tokenizer's library;
3. the pre-token frequencies of each document are joined to these counts and summed.

The join has two sides.  The most frequent pre-tokens, at most ``frequent`` of them
whatever the corpus, are broadcast and joined where the text is split, so that a document becomes
one partial sum.  All others, which are rare and so never a hot key, are joined by a
shuffle on the pre-token.  Sums go by text: (XXH64, bytes) of the text is the key that
brings them back to the rows, so copies share a sum.

Defined results for unusual input: null text counts as an empty one (0 tokens); whole
texts of any length count; repeated rows each get their count; an empty table gives an
empty table; the result column takes the place of an input column of the same name.
``df`` is read three times: write it to a table first where it is costly.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.pretokens import Pieces, blocks, factorise, splitter
from helixframe.runtime import bound_batches, fresh, materialize

#: Pre-tokens that are broadcast with their counts, at most (about 10 MB).
FREQUENT = 400_000
#: Steps of a factor of two in which frequencies are told apart when the broadcast ones are chosen.
STEPS = 8
#: Pre-tokens that the library counts at once.
COUNTED = 20_000
#: The pre-tokenizer whose pre-tokens the regular expression finds (fixed value of the file format).
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


class PieceCounter:
    """Counts tokens of pre-tokens as the ``tokenizers`` library does for the .json file at ``path``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            form = json.load(f)
        pre, added = form["pre_tokenizer"] or {}, form["added_tokens"]
        if form["normalizer"] or any(pre.get(k) != v for k, v in BYTE_LEVEL.items()) or any(x[k] for x in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: only byte-level tokenizers with plain added tokens are supported")
        self.library = Tokenizer.from_file(path)
        names = sorted((x["content"] for x in added), key=len, reverse=True)
        self.special = "|".join(map(re.escape, names))

    def split(self, text: str) -> list[str]:
        """Pre-tokens between the added tokens."""
        return [x for part in re.split(self.special, text) for x in splitter()(part)] if self.special else splitter()(text)

    def pieces(self, texts: pa.Array) -> tuple[Pieces, np.ndarray]:
        """The pre-tokens of the texts (none null), and how many added tokens each text has."""
        added = pc.count_substring_regex(texts, self.special) if self.special else pa.array([0] * len(texts), pa.int32())
        added = added.to_numpy(zero_copy_only=False).astype(np.int64)
        return factorise(texts, whole=added > 0, cut=self.split), added

    def counts(self, names: list[str]) -> np.ndarray:
        parts = (self.library.encode_batch(names[k : k + COUNTED], add_special_tokens=False) for k in range(0, len(names), COUNTED))
        return np.fromiter((len(x) for part in parts for x in part), np.int64, len(names))


@lru_cache(2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


_tables: dict[str, dict[str, int]] = {}


def _common(name: str, shared) -> dict[str, int]:
    """The broadcast pre-tokens and their counts, as a worker keeps them."""
    if name not in _tables:
        _tables.clear()
        with pa.ipc.open_stream(shared.value) as found:
            table = found.read_all()
        _tables[name] = dict(zip(table["piece"].to_pylist(), table["tokens"].to_pylist(), strict=True))
    return _tables[name]


def _distinct(batches, path: str):
    for batch in batches:
        for texts in blocks(batch["text"]):
            (names, codes, _), _ = counter(path).pieces(texts)
            yield pa.RecordBatch.from_pydict({"piece": pa.array(names, pa.string()), "n": pa.array(np.bincount(codes, minlength=len(names)), pa.int64())})


def _counted(batches, path: str):
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"piece": batch["piece"], "n": batch["n"], "tokens": pa.array(counter(path).counts(batch["piece"].to_pylist()), pa.int64())})


def _frequencies(batches, path: str, common_of):
    """For each text a row with its broadcast pre-tokens' sum, and one for each of its other pre-tokens.

    The first kind has a name of its own as ``piece``, which occurs 0 times, so that these
    rows spread over the join like the others.
    """
    common = common_of()
    for batch in batches:
        at = 0
        for texts in blocks(batch["text"]):
            (names, codes, ends), added = counter(path).pieces(texts)
            count = np.fromiter((common.get(x, -1) for x in names), np.int64, len(names))
            each = count[codes]
            rare = np.flatnonzero(each < 0)
            each[rare] = 0
            sums = np.diff(np.concatenate(([0], np.cumsum(each)))[ends]) + added
            cells, n = np.unique((np.searchsorted(ends, rare, "right") - 1) * len(names) + codes[rare], return_counts=True)
            row, code = np.divmod(cells, max(1, len(names)))
            h, size = (batch[c].slice(at, len(texts)).to_numpy() for c in ("h", "size"))
            at += len(texts)
            own = [f"{x:x} {i}" for i, x in enumerate(h.tolist())]
            zero, one = np.zeros(len(row), np.int64), np.ones(len(h), np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "h": pa.array(np.concatenate((h, h[row]))),
                    "size": pa.array(np.concatenate((size, size[row]))),
                    "piece": pa.concat_arrays([pa.array(own, pa.string()), pa.array(names, pa.string()).take(pa.array(code))]),
                    "n": pa.array(np.concatenate((one * 0, n))),
                    "known": pa.array(np.concatenate((sums, zero))),
                    "texts": pa.array(np.concatenate((one, zero))),
                }
            )


def piece_counts(df: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Rows (piece, n, tokens): every distinct pre-token of the texts, its occurrences, and its tokens."""
    bound_batches(df.sparkSession)
    texts = df.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    distinct = texts.mapInArrow(lambda b: _distinct(b, tokenizer), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return distinct.mapInArrow(lambda b: _counted(b, tokenizer), "piece string, n long, tokens long")


def count_tokens(df: DataFrame, tokenizer: str, text: str = "text", out: str = "n_tokens", frequent: int = FREQUENT) -> DataFrame:
    """``df`` with the column ``out`` (long): tokens of the whole text, without begin, end or added special tokens."""
    context = df.sparkSession.sparkContext
    counted = materialize(piece_counts(df, tokenizer, text), "pieces").withColumn("step", F.floor(F.log2("n") * STEPS).cast("int"))
    least, held = 64 * STEPS, 0
    for r in sorted(counted.groupBy("step").count().collect(), reverse=True):  # at most 64 * STEPS rows
        if (held := held + r["count"]) > frequent:
            break
        least = r["step"]
    common = counted.where(F.col("step") >= least).select("piece", "tokens").toArrow()  # at most ``frequent`` rows
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, common.schema) as stream:
        stream.write_table(common)
    name, shared = uuid.uuid4().hex, context.broadcast(sink.getvalue().to_pybytes())

    h, size = fresh(df, "h"), fresh(df, "size")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = df.withColumns({h: F.xxhash64(body), size: F.octet_length(body).cast("long")})
    texts = keyed.select(F.col(h).alias("h"), F.col(size).alias("size"), body.alias("text"))
    rows = texts.mapInArrow(lambda b: _frequencies(b, tokenizer, lambda: _common(name, shared)), "h long, size long, piece string, n long, known long, texts long")
    rare = counted.where(F.col("step") < least).select("piece", "tokens")
    tokens = F.col("known") + F.col("n") * F.coalesce("tokens", F.lit(0))
    sums = rows.join(rare, "piece", "left").groupBy("h", "size").agg(F.sum(tokens).alias("all"), F.sum("texts").alias("texts"))
    # Copies of a text add up to the same sum for each.
    sums = sums.select(F.col("h").alias(h), F.col("size").alias(size), F.expr("all div texts").alias(fresh(df, "tokens")))
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() != out.lower()]
    return keyed.join(sums, [h, size]).select(*kept, F.col(fresh(df, "tokens")).alias(out))
