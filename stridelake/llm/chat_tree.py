r"""Chat formatting with a prefix tree.

Conversations that share initial turns share the tree's nodes. A node is a turn after a given history,
named by a chained digest of all turns up to it; a conversation's path is the row of its nodes' digests.
Sorting distinct paths puts each tree in depth-first order, so trees are written while sorted ranges are
read: a shared turn's tokens come once per block, followed by what branches off it. A block holds one
tree, or a stretch of it of about BLOCK_TOKENS tokens; where a large tree is cut, the next block repeats
the path to the cut. A node carries the position id of its first token (position goes on from its parent)
and the intervals of the block that its tokens may attend to before themselves: its ancestors.

Template: `<s>`, then per turn  user `[INST]text[/INST]`, assistant `text</s>`, system `[SYS]text[/SYS]`,
any other role `[ROLE]role[/ROLE]text</s>`. Marks are single ids beyond the vocabulary. Inside texts a
backslash is doubled and a control string gets one after its first character, so none occurs there.
The loss mask covers the tokens of assistant texts.

Defined cases: null texts and roles count as empty; turns are ordered by turn (null first), role, text;
repeated rows are repeated turns; a null conv_id is one conversation; a conversation longer than a block
gets a block of its own; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.common import materialize, prepare, read, small_or_shuffled

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]")
_ANY = re.compile("(" + "|".join(map(re.escape, CONTROL)) + ")")
#: Tokens of a block, about: the next conversation starts a new block once a block has this many.
BLOCK_TOKENS = 16_384
#: Bytes of nodes that a worker puts out at once, about. A long path that is repeated at each cut can make much of a small batch.
OUT_BYTES = 4 << 20
VOCABULARY, FIRST_MARK = "byte_bpe_50k.tiktoken", 50_257
DIGEST = 16


def escape(text: str) -> str:
    return _ANY.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def turn_parts(role: str, text: str) -> tuple[list[str], int]:
    """The turn's control strings and escaped texts in order, and the index of its text."""
    e = escape(text)
    if role == "user":
        return ["[INST]", e, "[/INST]"], 1
    if role == "assistant":
        return [e, "</s>"], 0
    if role == "system":
        return ["[SYS]", e, "[/SYS]"], 1
    return ["[ROLE]", escape(role), "[/ROLE]", e, "</s>"], 3


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    parts = _ANY.split(formatted)
    if parts[:2] != ["", "<s>"]:
        raise ValueError("no start mark")
    turns, at = [], 2
    while at < len(parts) - 1:
        literal, mark = parts[at], parts[at + 1]
        if mark == "</s>":
            turns.append(("assistant", unescape(literal)))
            at += 2
        elif mark in ("[INST]", "[SYS]") and not literal:
            turns.append(("user" if mark == "[INST]" else "system", unescape(parts[at + 2])))
            at += 4
        elif mark == "[ROLE]" and not literal:
            turns.append((unescape(parts[at + 2]), unescape(parts[at + 4])))
            at += 6
        else:
            raise ValueError(f"unexpected {mark}")
    return turns


_ENCODINGS: dict[str, object] = {}


def encoding(path: str):
    """The byte-level vocabulary, which gives any text back exactly."""
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def node_tokens(enc, role: str, text: str) -> tuple[np.ndarray, int, int]:
    """Ids of a turn, and where its loss span starts and ends (equal: none)."""
    parts, which = turn_parts(role, text)
    ids: list[int] = []
    span = (0, 0)
    for i, p in enumerate(parts):
        begin = len(ids)
        ids += [FIRST_MARK + CONTROL.index(p)] if p in CONTROL else enc.encode_ordinary(p)
        if i == which and role == "assistant":
            span = (begin, len(ids))
    return np.array(ids, np.uint32), *span


def detokenize(enc, ids: np.ndarray) -> str:
    out, begin = [], 0
    for at in [*np.flatnonzero(ids >= FIRST_MARK).tolist(), len(ids)]:
        if at > begin:
            out.append(enc.decode_bytes(ids[begin:at].tolist()))
        if at < len(ids):
            out.append(CONTROL[int(ids[at]) - FIRST_MARK].encode())
        begin = at + 1
    return b"".join(out).decode()


TURNS = "array<struct<role:string,text:string>>"


def conversations(rows: DataFrame) -> DataFrame:
    """conv_id, leaf, path, turns: a row per conversation. path is the concatenated digests of its nodes."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = []
            for turns in batch.column("turns").to_pylist():
                last, path = b"", []
                for t in turns:
                    role, text = t["role"].encode(), t["text"].encode()
                    last = hashlib.blake2b(last + len(role).to_bytes(4, "big") + role + text, digest_size=DIGEST).digest()
                    path.append(last)
                paths.append(b"".join(path))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array([p[-DIGEST:] for p in paths], pa.binary()), pa.array(paths, pa.binary()), batch.column("turns")], ["conv_id", "leaf", "path", "turns"])

    plain = grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    return plain.mapInArrow(run, f"conv_id long, leaf binary, path binary, turns {TURNS}")


NODES = "block_id string, place int, node binary, parent binary, depth int, role string, start int, length int, position int, attend array<struct<start:int,end:int>>, loss_start int, loss_end int, ids binary, is_leaf boolean"


def node_batches(batches: Iterator[pa.RecordBatch], path: str, block_tokens: int = BLOCK_TOKENS, out_bytes: int = OUT_BYTES) -> Iterator[pa.RecordBatch]:
    """The nodes of conversations that come in the order of their paths, in batches of about out_bytes, or one node."""
    names = [c.split()[0] for c in re.sub("<[^ ]*>", "", NODES).split(", ")]
    kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.int32(), pa.int32(), pa.binary(), pa.bool_()]
    enc = encoding(path)
    block, size, place, waiting = "", 0, 0, 0
    stack: list[tuple[bytes, int, int, int]] = []  # digest, start, end, position after it
    rows: list[tuple] = []

    def table() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    for batch in batches:
        for leaf, digests, turns in zip(batch.column("leaf").to_pylist(), batch.column("path").to_pylist(), batch.column("turns").to_pylist(), strict=True):
            nodes = [digests[i : i + DIGEST] for i in range(0, len(digests), DIGEST)]
            shared = 0
            while shared < min(len(stack), len(nodes)) and stack[shared][0] == nodes[shared]:
                shared += 1
            if not shared or size >= block_tokens:
                block, size, place, shared = leaf.hex(), 0, 0, 0
            del stack[shared:]
            for depth in range(shared, len(nodes)):
                role, text = turns[depth]["role"], turns[depth]["text"]
                ids, a, b = node_tokens(enc, role, text)
                if not depth:
                    ids, a, b = np.concatenate([np.array([FIRST_MARK], np.uint32), ids]), a + 1, b + 1
                attend: list[dict] = []
                for _, s, e, _ in stack:
                    if attend and attend[-1]["end"] == s:
                        attend[-1]["end"] = e
                    else:
                        attend.append({"start": s, "end": e})
                position = stack[-1][3] if stack else 0
                rows.append((block, place, nodes[depth], nodes[depth - 1] if depth else None, depth, role, size, len(ids), position, attend, size + a, size + b, ids.astype("<u4").tobytes(), depth == len(nodes) - 1))
                stack.append((nodes[depth], size, size + len(ids), position + len(ids)))
                size, place, waiting = size + len(ids), place + 1, waiting + 4 * len(ids) + 100
                if waiting >= out_bytes:
                    yield table()
                    rows, waiting = [], 0
    if rows:
        yield table()


def tree_nodes(convs: DataFrame, path: str | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """From distinct conversations (leaf, path, turns): a row per node of each block, in depth-first order.

    start and length count tokens of the block, as do attend (the ancestors' tokens) and the loss span."""
    path = path or vocabulary_path()
    ranged = convs.select("leaf", "path", "turns").repartitionByRange("path").sortWithinPartitions("path")
    return ranged.mapInArrow(lambda batches: node_batches(batches, path, block_tokens), NODES)


def read_back(nodes: DataFrame, path: str | None = None) -> DataFrame:
    """leaf, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the blocks alone.

    Each conversation is what its last node attends to, and that node."""
    path = path or vocabulary_path()

    def leaves(enc, rows: list[dict]) -> list[tuple]:
        ids = np.frombuffer(b"".join(r["ids"] for r in rows), "<u4")
        mask = np.zeros(len(ids) + 1, bool)
        for r in rows:
            mask[r["loss_start"] : r["loss_end"]] = True
        out = []
        for r in rows:
            if not r["is_leaf"]:
                continue
            parts = [(x["start"], x["end"]) for x in r["attend"]] + [(r["start"], r["start"] + r["length"])]
            mine = np.concatenate([ids[a:b] for a, b in parts])
            under = np.concatenate([[False], *(mask[a:b] for a, b in parts), [False]])
            if len(mine) != r["position"] + r["length"]:
                raise ValueError("position ids and ancestors disagree")
            formatted = detokenize(enc, mine)
            edges = np.flatnonzero(under[1:] != under[:-1])
            loss = "".join(unescape(detokenize(enc, mine[a:b])) for a, b in zip(edges[::2], edges[1::2], strict=True))
            turns = parse(formatted)
            digest = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode())
            out.append((r["node"], len(turns), digest.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path)
        kinds = [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        held: list[dict] = []

        def table(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names)

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if held and r["block_id"] != held[0]["block_id"]:
                    out += leaves(enc, held)
                    held = []
                held.append(r)
            yield table(out)
        if held:
            yield table(leaves(enc, held))

    rows = nodes.select("block_id", "place", "node", "start", "length", "position", "attend", "loss_start", "loss_end", "ids", "is_leaf")
    ordered = rows.repartition("block_id").sortWithinPartitions("block_id", "place")
    return ordered.mapInArrow(run, "leaf binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def format_chats(rows: DataFrame, path: str | None = None, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """The stored nodes of all trees, and conv_id with the leaf that ends it."""
    prepare(rows.sparkSession)
    convs = materialize(conversations(rows), "chats")
    nodes = materialize(tree_nodes(convs.dropDuplicates(["leaf"]), path, block_tokens), "chat-trees")
    return nodes, convs.select("conv_id", "leaf")


def op3_chat_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    nodes, members = format_chats(rows.unionByName(planted))
    found = read_back(nodes)
    return members.join(small_or_shuffled(materialize(found, "chat-digests"), limit=200_000), "leaf").drop("leaf")


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
u AS (
  SELECT *, length(text) + (length(text) - length(replace(text, '\', ''))) + (length(text) - length(replace(text, '<s>', ''))) // 3
    + (length(text) - length(replace(text, '</s>', ''))) // 4 + (length(text) - length(replace(text, '[INST]', ''))) // 6 + (length(text) - length(replace(text, '[/INST]', ''))) // 7
    + (length(text) - length(replace(text, '[SYS]', ''))) // 5 + (length(text) - length(replace(text, '[/SYS]', ''))) // 6 + (length(text) - length(replace(text, '[ROLE]', ''))) // 6
    + (length(text) - length(replace(text, '[/ROLE]', ''))) // 7
    + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 4 WHEN 'system' THEN 11 ELSE 17 + length(role) END AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM u GROUP BY conv_id
"""
