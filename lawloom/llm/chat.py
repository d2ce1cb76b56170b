"""Chat formatting as a prefix tree with shared turns emitted once.

A conversation is a path of turns; conversations with equal initial turns share those nodes. A node's name is a hash
chained along its path, so equal prefixes meet by grouping on it, in any order and on any machine, and a first turn
shared by a third of all conversations costs one row. The tree is emitted depth-first: paths (their nodes' names in
order) sort every node before its descendants and siblings' subtrees one after the other, so a node's place is a
running sum of lengths over the sorted nodes. That sum is taken per partition and carried over partition borders by one
small summary, so a large tree may span many tasks. Each node has its place in its tree's sequence, the position id of
its first token (how many tokens precede it in a conversation; the others follow on) and the intervals of the sequence
that its tokens attend to besides their own node: its ancestors'.

Template: ``<|role|>\\n``, the text, ``<|end|>\\n`` per turn. Inside roles and texts one backslash more is put into every
control string (this template's own and those of other common ones), which unescape takes out again. Mark, text and
end are tokenized apart, so the loss mask covers exactly the texts of assistants.

Defined results: null texts and roles are empty; turns are ordered by turn, then role and text (null turns first), and
repeated rows are turns of their own; a row without a conversation id is a conversation of its own, of one turn; an empty
table gives nothing; other columns are left alone. A single conversation is held by one task, like a document.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import cut
from lawloom.llm.tokens import Encoder

# Control strings of chat templates, written so that a backslash fits after the first character.
_CONTROL = r"(<\\*(?=\||/?s>|</?SYS>>)|\|\\*(?=>)|\[\\*(?=/?INST\]))"
_FIND = re.compile(_CONTROL)
_BACK = re.compile(r"<\\(?=\\*(?:\||/?s>|</?SYS>>))|\|\\(?=\\*>)|\[\\(?=\\*/?INST\])")
_TURN = re.compile(r"<\|(.*?)\|>\n(.*?)<\|end\|>\n", re.DOTALL)
_NAME = 16

LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    return _FIND.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _BACK.sub(lambda m: m[0][:1], text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}: {formatted[at : at + 40]!r}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def paths(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """A row for each turn: conv_id, path (names of the nodes down to its own), position, ids, loss span, whether it is the last."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    conv = F.col("conv_id").cast("long")
    own = conversations.select(conv.alias("conv_id"), F.when(conv.isNull(), F.monotonically_increasing_id()).alias("row"), turn.alias("t"))
    convs = own.groupBy("conv_id", "row").agg(F.sort_array(F.collect_list("t")).alias("turns")).drop("row")
    names = ["conv_id", "path", "position", "ids", "loss_from", "loss_to", "n_turns", "last"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]

    def run(batches):
        encode = Encoder.of(tokenizer)
        for b in batches:
            columns = [[] for _ in names]
            for conv, turns in zip(b["conv_id"].to_pylist(), b["turns"].to_pylist()):
                path, position = b"", 0
                marks = encode.many([x for t in turns for x in (f"<|{escape(t['role'])}|>\n", escape(t["text"]), "<|end|>\n")])
                for n, t in enumerate(turns):
                    mark, body, end = marks[3 * n : 3 * n + 3]
                    own = hashlib.blake2b(path[-_NAME:] + f"{len(t['role'])}:{t['role']}{t['text']}".encode(), digest_size=_NAME).digest()
                    path += own
                    ids = mark + body + end
                    loss = (len(mark) // 4, (len(mark) + len(body)) // 4) if t["role"] == LOSS_ROLE else (0, 0)
                    for column, x in zip(columns, (conv, path, position, ids, *loss, len(turns), n + 1 == len(turns))):
                        column.append(x)
                    position += len(ids) // 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return convs.mapInArrow(run, "conv_id long, path binary, position long, ids binary, loss_from long, loss_to long, n_turns long, last boolean")


def _part(path: str, at: int) -> F.Column:
    return F.expr(f"substring({path}, {at}, {_NAME})")


def pack(turns: DataFrame) -> DataFrame:
    """The nodes of all trees with their place: tree, start, length, node, parent, depth, n_convs, position, ids, loss_from, loss_to, ancestors."""
    nodes = turns.groupBy("path").agg(F.count("*").alias("n_convs"), *(F.first(c).alias(c) for c in ("position", "ids", "loss_from", "loss_to")))
    ordered = nodes.withColumn("length", (F.octet_length("ids") / 4).cast("long")).repartitionByRange("path").sortWithinPartitions("path")
    schema = ordered.schema

    def run(batches):
        here, tree, at, carried, first = TaskContext.get().partitionId(), None, 0, False, True
        for b in batches:
            starts, flags, heads = [], [], []
            for path, n in zip(b["path"].to_pylist(), b["length"].to_pylist()):
                heads.append(first and len(path) > _NAME)
                if path[:_NAME] != tree:
                    tree, at = path[:_NAME], 0
                    carried, first = first and len(path) > _NAME, False
                starts.append(at)
                flags.append(carried)
                at += n
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(starts, pa.int64()), pa.array(flags, pa.bool_()), pa.array(heads, pa.bool_()), pa.array([here] * len(starts), pa.int32())], [*b.schema.names, "start", "carried", "head", "part"])

    placed = ordered.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", start long, carried boolean, head boolean, part int")
    placed = cut(placed.withColumn("tree", _part("path", 1)))
    # trees that cross a border: at most one for each partition, with one length for each partition they touch
    crossing = placed.where("carried").select("tree").distinct()
    lengths = placed.join(F.broadcast(crossing), "tree", "left_semi").groupBy("tree", "part").agg(F.max(F.col("start") + F.col("length")).alias("n")).collect()
    before, was, total = {}, None, 0
    for r in sorted(lengths, key=lambda r: (bytes(r["tree"]), r["part"])):
        tree = bytes(r["tree"])
        total = total if tree == was else 0
        before[tree, r["part"]], was = total, tree
        total += r["n"]
    spark = turns.sparkSession
    carry = spark.createDataFrame([(bytearray(t), p, n) for (t, p), n in before.items()], "tree binary, part int, before long")
    placed = placed.join(F.broadcast(carry), ["tree", "part"], "left").withColumn("start", F.col("start") + F.coalesce("before", F.lit(0).cast("long")))
    return _with_ancestors(placed.drop("before", "carried"))


def _merged(spans: list[tuple[int, int]], span: tuple[int, int]) -> list[tuple[int, int]]:
    """The intervals with one more behind them; neighbours become one."""
    return [*spans[:-1], (spans[-1][0], span[1])] if spans and spans[-1][1] == span[0] else [*spans, span]


def _with_ancestors(placed: DataFrame) -> DataFrame:
    """Adds node, parent, depth and ancestors: the intervals of the nodes above, merged where they touch.

    Nodes are read in depth-first order, so those above a node are on a stack. What lies above a partition's first
    node in earlier partitions is looked up by its path: at most one path for each partition.
    """
    heads = placed.where("head").select("part", F.explode(F.transform(F.sequence(F.lit(1), F.expr(f"int(octet_length(path) / {_NAME}) - 1")), lambda i: F.col("path").substr(F.lit(1), i * _NAME))).alias("path"))
    above: dict[int, list[tuple[int, int, int]]] = {}
    for r in heads.join(placed.select("path", "start", "length"), "path").select("part", F.octet_length("path").alias("n"), "start", "length").collect():
        above.setdefault(r["part"], []).append((r["n"] // _NAME, r["start"], r["start"] + r["length"]))
    shared = placed.sparkSession.sparkContext.broadcast({p: sorted(x) for p, x in above.items()})
    names = ["tree", "start", "length", "n_convs", "position", "ids", "loss_from", "loss_to"]
    kinds = dict(placed.dtypes)

    def run(batches):
        stack: list[tuple[int, list]] | None = None  # depth, and the intervals down to that node
        for b in batches:
            nodes, parents, depths, ancestors = [], [], [], []
            for path, start, n, part in zip(*(b[c].to_pylist() for c in ("path", "start", "length", "part"))):
                if stack is None:
                    stack, spans = [], []
                    for d, x, y in shared.value.get(part, ()):
                        spans = _merged(spans, (x, y))
                        stack.append((d, spans))
                depth = len(path) // _NAME
                while stack and stack[-1][0] >= depth:
                    stack.pop()
                own = stack[-1][1] if depth > 1 else []
                stack.append((depth, _merged(own, (start, start + n))))
                nodes.append(path[-_NAME:])
                parents.append(path[-2 * _NAME : -_NAME] or None)
                depths.append(depth - 1)
                ancestors.append([{"from": x, "to": y} for x, y in own])
            more = [pa.array(nodes, pa.binary()), pa.array(parents, pa.binary()), pa.array(depths, pa.int32()), pa.array(ancestors, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])))]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in names), *more], [*names, "node", "parent", "depth", "ancestors"])

    return placed.select(*names, "path", "part").mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in names) + ", node binary, parent binary, depth int, ancestors array<struct<from:bigint,to:bigint>>")


def format_conversations(conversations: DataFrame, tokenizer: str) -> tuple[DataFrame, DataFrame]:
    """The packed nodes, and for each conversation its id, number of turns and path of nodes."""
    turns = cut(paths(conversations, tokenizer))
    members = turns.where("last").select("conv_id", "n_turns", "path")
    return pack(turns), members


def read_back(packed: DataFrame, members: DataFrame, tokenizer: str) -> DataFrame:
    """conv_id, formatted and loss_text, from the packed tokens: those of a path's nodes, in order of position.

    That these are what the last node attends to is checked on the way.
    """
    ups = F.transform(F.sequence(F.lit(0), F.expr(f"int(octet_length(path) / {_NAME}) - 1")), lambda i: F.col("path").substr(i * _NAME + 1, F.lit(_NAME)))
    leaf = F.expr(f"substring(path, -{_NAME})")  # its name stands for the whole path
    wanted = members.select("path").distinct().select(leaf.alias("leaf"), F.explode(ups).alias("node"))
    members = members.select("conv_id", "n_turns", leaf.alias("leaf"))
    last = F.col("leaf") == F.col("node")
    parts = wanted.join(packed.select("node", "start", "length", "position", "ids", "loss_from", "loss_to", "ancestors"), "node")
    whole = parts.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("position", "start", "length", "ids", "loss_from", "loss_to", F.when(last, F.col("ancestors")).alias("ancestors")))).alias("parts"))

    def run(batches):
        decode = Encoder.of(tokenizer).decode
        for b in batches:
            full, loss = [], []
            for nodes in b["parts"].to_pylist():
                spans: list[tuple[int, int]] = []
                for x in nodes[:-1]:
                    spans = _merged(spans, (x["start"], x["start"] + x["length"]))
                if [(a["from"], a["to"]) for a in nodes[-1]["ancestors"]] != spans:
                    raise ValueError("a node's intervals are not those of the nodes above it")
                full.append(decode(b"".join(x["ids"] for x in nodes)))
                loss.append("".join(unescape(decode(x["ids"][4 * x["loss_from"] : 4 * x["loss_to"]])) for x in nodes if x["loss_to"] > x["loss_from"]))
            yield pa.RecordBatch.from_arrays([b["leaf"], pa.array(full, pa.string()), pa.array(loss, pa.string())], ["leaf", "formatted", "loss_text"])

    return members.join(whole.mapInArrow(run, "leaf binary, formatted string, loss_text string"), "leaf").drop("leaf")


def digest(texts: DataFrame) -> DataFrame:
    """The counts and hashes of what read_back gives; turns are parsed from the formatted text."""

    def run(batches):
        for b in batches:
            turns = [parse(t) for t in b["formatted"].to_pylist()]
            loss = b["loss_text"].to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    b["conv_id"],
                    pa.array([len(t) for t in turns], pa.int64()),
                    pa.array([hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest() for t in turns], pa.string()),
                    pa.array([len(t) for t in loss], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in loss], pa.string()),
                    pa.array([len(t) for t in b["formatted"].to_pylist()], pa.int64()),
                ],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return texts.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
