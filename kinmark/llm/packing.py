"""Filling training windows with documents: vector bin packing by dot products.

A document is an example of instruction data: its heading line, or else its
first sentence if more follows, is the prompt, and the rest, which the model
has to give, bears loss.  So it is an item with three sizes: tokens, one
segment, loss-bearing tokens.  A window limits all three at once: C tokens,
C / ``TOKENS_A_SEGMENT`` segments and ``LOSS_SHARE`` C loss-bearing tokens.
Windows are filled one after another: of the items that still fit, the one
whose sizes have the largest dot product with the window's remaining room (each
as a share of its limit) comes next.  Only where that choice would close the
window with room unused, one item or a pair that fills the room exactly is
taken instead, if there is one.  A text longer than the window is cut into
whole windows and a rest; no other text is divided, and every text is placed
once.

Scale: tokens are counted in one pass and written once; pieces of full length
never meet others (a window each).  The rest goes by hash into shards of about
``SHARD_ITEMS`` items, each packed by one task in constant memory, so the work
per task does not grow with the corpus; a shard leaves at most its last window
unfilled.

Edge cases: NULL texts and empty texts have no tokens and are placed, as items
of size 0, on one row with part_no 0 and a NULL window; an item that exceeds
the limit of loss-bearing tokens by itself (a text without a prompt, or a part
of a long one) has a window of its own; repeated documents are separate rows;
an empty table gives no rows; a NULL or non-positive capacity is left out.
"""

from __future__ import annotations

import base64
import os
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of public vocabulary files (a parameter, never copied).
TOKENIZER_DIR = os.environ.get("KINMARK_TOKENIZERS", "/opt/tokenizers")
#: Vocabulary file for each tokenizer named by a pack size; a name without its own file on this box takes the default.
TOKENIZER_FILES = {"byte_bpe_50k": "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k": "byte_bpe_multi_50k.tiktoken"}
DEFAULT_TOKENIZER = "byte_bpe_50k"
#: Fixed value: the pattern that cuts text before byte pairs are merged.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SHARD_ITEMS = 25_000
#: A window of C tokens has room for C // TOKENS_A_SEGMENT segments and LOSS_SHARE * C loss-bearing tokens.
TOKENS_A_SEGMENT = 48
LOSS_SHARE = 0.96

_HEADING = re.compile(r"\A\s*(?:<[^<>]{1,40}>)?([^\n]{1,80})\n")
_SENTENCE = re.compile(r"\A\s*(?:\S+\s+){2,60}?\S*[^\W\d_]{2}[.!?](?=\s+\S)")
_encoders: dict[int, object] = {}


def encoder(vocabulary: bytes) -> object:
    """The tokenizer of a vocabulary file's content, made once for each process."""
    import tiktoken

    key = hash(vocabulary)
    if key not in _encoders:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        _encoders[key] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[key]


def read_vocabulary(name: str | None, folder: str = TOKENIZER_DIR) -> bytes:
    """Content of a tokenizer's file, about 1 MB; it travels to the executors with the task."""
    file = TOKENIZER_FILES.get(name or "", TOKENIZER_FILES[DEFAULT_TOKENIZER])
    with open(os.path.join(folder, file), "rb") as f:
        return f.read()


def heading(text: str) -> str:
    """The heading line of a text, if it has one: a short first line without a full stop at its end."""
    m = _HEADING.match(text)
    return m.group(0) if m and not m.group(1).rstrip().endswith((".", ",", ";")) else ""


def prompt(text: str) -> str:
    """What of a text is context only: its heading line, or else its first sentence (of 60 words at most) if more follows."""
    if h := heading(text):
        return h
    m = _SENTENCE.match(text)
    return m.group(0) if m else ""


def count_tokens(docs: DataFrame, vocabulary: bytes) -> DataFrame:
    """doc_id, tokens, loss: sizes of every document's whole text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            n = [len(enc.encode_ordinary(t)) for t in texts]
            head = [len(enc.encode_ordinary(h)) if (h := prompt(t)) else 0 for t in texts]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "tokens": n, "loss": np.maximum(np.subtract(n, head), 0)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id bigint, tokens int, loss int")


def fill(tokens: np.ndarray, loss: np.ndarray, capacity: int, segments: int, loss_limit: int) -> np.ndarray:
    """Window number of each item (all of 1..capacity tokens), filling windows by the dot-product rule.

    Of items with equally many tokens, the one comes whose loss-bearing tokens
    come nearest to the share of them for which the window still has room.
    """
    window = np.empty(len(tokens), dtype=np.int64)
    items: list[list[int]] = [[] for _ in range(capacity + 1)]  # of each size, by loss
    losses: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in np.lexsort((np.arange(len(tokens)), loss, tokens)).tolist():
        items[tokens[i]].append(i)
        losses[tokens[i]].append(int(loss[i]))
    size = np.arange(capacity + 1)
    beyond = capacity + 1
    most = np.array([x[-1] if x else 0 for x in losses])
    least = np.array([x[0] if x else beyond for x in losses])  # of a size without items it fits nowhere
    high, low = capacity, 1
    n = 0
    remaining = len(tokens)

    def nearest(t: int, wanted: float) -> int:
        return max(0, bisect_right(losses[t], wanted) - 1)

    def take(t: int, wanted: float) -> int:
        """Put the item of a size into the window that has at most the wanted loss, else the least; gives its loss."""
        nonlocal remaining
        remaining -= 1
        i = nearest(t, wanted)
        window[items[t].pop(i)] = n
        lost = losses[t].pop(i)
        most[t], least[t] = (losses[t][-1], losses[t][0]) if losses[t] else (0, beyond)
        return lost

    def exact(room: int, may_lose: int, places: int) -> int:
        """A size that fills the room alone or together with another one; 0 if there is none."""
        if room <= high and least[room] <= may_lose:
            return room
        if places < 2 or room > 2 * high:
            return 0
        a = np.arange(max(1, room - high), room // 2 + 1)
        b = room - a
        for i in np.flatnonzero(least[a] + least[b] <= may_lose):
            x, y = int(a[i]), int(b[i])
            if (x != y or len(items[x]) > 1) and losses[y][nearest(y, y * may_lose / room)] + losses[x][0 if x != y else 1] <= may_lose:
                return y
        return 0

    while remaining:
        room, places, may_lose = capacity, segments, loss_limit
        while not items[high]:
            high -= 1
        while not items[low]:
            low += 1
        while room and places:
            reach = min(room, high) + 1
            fits = np.flatnonzero(least[:reach] <= may_lose)
            if not len(fits):
                if room == capacity:  # an item that exceeds a limit by itself has a window of its own
                    take(high, 0)
                break
            lost = np.clip(size[fits] * (may_lose / room), least[fits], most[fits])
            dot = size[fits] * (room / capacity**2) + lost * (may_lose / max(1, loss_limit) ** 2)
            pick = int(fits[np.argmax(dot)])
            if 0 < room - pick < low or places == 1:
                pick = exact(room, may_lose, places) or pick
            may_lose -= take(pick, pick * may_lose / room)
            room -= pick
            places -= 1
        n += 1
    return window


PLACED = "doc_id bigint, part_no int, start int, tokens int, loss int, window string"


def pack(sizes: DataFrame, name: str, capacity: int) -> DataFrame:
    """pack_name, window, doc_id, part_no, start, tokens, loss of every part of every document."""
    loss_limit = int(LOSS_SHARE * capacity)
    segments = max(1, capacity // TOKENS_A_SEGMENT)
    parts = sizes.withColumn("part_no", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.col("tokens") / capacity).cast("int")))))
    start = (F.col("part_no") - 1) * capacity
    size = F.least(F.col("tokens") - start, F.lit(capacity))
    # context comes first: what is not loss-bearing lies at the beginning of the text
    context = F.least(size, F.greatest(F.lit(0), F.col("tokens") - F.col("loss") - start))
    parts = parts.select(
        "doc_id",
        F.when(F.col("tokens") > 0, F.col("part_no")).otherwise(0).cast("int").alias("part_no"),
        start.cast("int").alias("start"),
        size.cast("int").alias("size"),
        (size - context).cast("int").alias("loss"),
    ).withColumnRenamed("size", "tokens")
    full = F.col("tokens") == capacity
    alone = parts.where(full | (F.col("tokens") == 0)).select("*", F.when(full, F.concat_ws("-", F.lit("d"), "doc_id", "part_no")).alias("window"))
    rest = parts.where(~full & (F.col("tokens") > 0))
    shards = max(1, -(-sizes.count() // SHARD_ITEMS))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        pdf = pdf.sort_values(["doc_id", "part_no"], kind="stable")
        w = fill(pdf["tokens"].to_numpy(), pdf["loss"].to_numpy(), capacity, segments, loss_limit)
        return pdf.assign(window=[f"s-{shard}-{n}" for n in w])[["doc_id", "part_no", "start", "tokens", "loss", "window"]]

    packed = rest.withColumn("shard", F.pmod(F.xxhash64("doc_id", "part_no"), F.lit(shards)).cast("int")).groupBy("shard").applyInPandas(run, PLACED)
    return packed.unionByName(alone).select(F.lit(name).alias("pack_name"), "window", "doc_id", "part_no", "start", "tokens", "loss")


def placed(packed: DataFrame) -> DataFrame:
    """pack_name, doc_id, whole: whether the parts of a document are its text from beginning to end, each once."""
    ends = F.sort_array(F.collect_list(F.struct("start", (F.col("start") + F.col("tokens")).alias("end"))))
    per = packed.groupBy("pack_name", "doc_id").agg(ends.alias("p"))
    joined = F.forall(F.sequence(F.lit(1), F.size("p")), lambda i: F.get("p", i - 1)["start"] == F.when(i == 1, 0).otherwise(F.get("p", i - 2)["end"]))
    return per.select("pack_name", "doc_id", joined.alias("whole"))


def usage(packed: DataFrame, capacities: dict[str, int]) -> DataFrame:
    """pack_name, windows, tokens, unused_share."""
    per = packed.where("window IS NOT NULL").groupBy("pack_name").agg(F.countDistinct("window").alias("windows"), F.sum("tokens").alias("tokens"))
    size = F.create_map(*[x for k, v in capacities.items() for x in (F.lit(k), F.lit(v))])
    room = F.col("windows") * size[F.col("pack_name")]
    return per.select("pack_name", "windows", "tokens", F.round(1 - F.col("tokens") / room, 6).alias("unused_share"))
