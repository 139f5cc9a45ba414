"""Chat formatting: records of many layouts become canonical turns, and turns become one marked text with a loss mask.

Schema fingerprinting finds a record's layout. The paths of its nested fields, sorted, are hashed; the hash selects a
declarative mapping that says where the turns, their roles and their texts stand. A fingerprint is matched with the
mappings once per worker and looked up from then on, so the cost of a record does not grow with the mappings. What a
mapping does not name is ignored.

A turn is written as START, role, line feed, text, END, line feed. Whatever in a text looks like a mark gets a backslash
inside, and one more if it already has some, so texts come back exactly and no text can open or close a turn.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator, Sequence
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight.llm.common import arrow_rows, in_pieces, ship

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
#: Fingerprints a worker remembers.
REMEMBERED = 50_000


class Turns(NamedTuple):
    """Where turns of one kind stand in a record.

    ``each`` is a path to a list with an element per turn, or empty where the record holds the turn itself. Further
    paths start there. ``role`` is a path, or ``fixed`` names the role. All of ``texts`` that are there are joined by an
    empty line; the values of one path are joined by nothing. A path goes through a list by ``[]``.
    """

    texts: tuple[str, ...]
    role: str = ""
    fixed: str = ""
    each: str = ""


class Layout(NamedTuple):
    """A mapping: it fits a record that has one path at least of every entry of ``needs``."""

    name: str
    needs: tuple[tuple[str, ...], ...]
    turns: tuple[Turns, ...]
    roles: dict[str, str] = {}


# The names some layouts have for the canonical roles.
SPEAKERS = {"human": "user", "gpt": "assistant"}

#: The layouts known at first. Where several fit, the one with the most needs is taken, then the first.
LAYOUTS = (
    Layout(
        "messages",
        (("messages[].role",), ("messages[].content", "messages[].content[].text", "messages[].content[]")),
        (Turns(("content", "content[]", "content[].text"), role="role", each="messages[]"),),
    ),
    Layout(
        "speakers",
        (("conversations[].from",), ("conversations[].value",)),
        (Turns(("value",), role="from", each="conversations[]"),),
        SPEAKERS,
    ),
    Layout(
        "instruction and output",
        (("instruction",), ("output",)),
        (
            Turns(("system",), fixed="system"),
            Turns(("instruction", "input"), fixed="user"),
            Turns(("output",), fixed="assistant"),
        ),
    ),
    Layout(
        "prompt and answer",
        (("prompt", "question"), ("completion", "response", "answer")),
        (
            Turns(("system",), fixed="system"),
            Turns(("prompt", "question"), fixed="user"),
            Turns(("completion", "response", "answer"), fixed="assistant"),
        ),
    ),
    Layout("turn", (("role",), ("text", "content")), (Turns(("text", "content"), role="role"),)),
    Layout(
        "author and parts",
        (("author.role",), ("content.parts[]",)),
        (Turns(("content.parts[]",), role="author.role"),),
    ),
    Layout("system alone", (("system",),), (Turns(("system",), fixed="system"),)),
    Layout("prompt alone", (("prompt", "instruction"),), (Turns(("prompt", "instruction"), fixed="user"),)),
    Layout("answer alone", (("completion", "output"),), (Turns(("completion", "output"), fixed="assistant"),)),
)


def field_paths(value: Any, at: str = "") -> Iterator[str]:
    """The path of every leaf: names parted by dots, ``[]`` for a list. An empty object or list is a leaf."""
    if isinstance(value, dict) and value:
        for name, inner in value.items():
            yield from field_paths(inner, f"{at}.{_escaped(name)}" if at else _escaped(name))
    elif isinstance(value, list) and value:
        for inner in value:
            yield from field_paths(inner, f"{at}[]")
    else:
        yield at


def _escaped(name: str) -> str:
    return re.sub(r"([\\.\[])", r"\\\1", name)


def fingerprint(paths: Iterable[str]) -> str:
    """The hash of a set of paths, in hexadecimal."""
    return hashlib.blake2b("\n".join(sorted(set(paths))).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


class Converter:
    """Turns of records, with the layouts found so far by fingerprint."""

    def __init__(self, layouts: Sequence[Layout] = LAYOUTS, remember: int = REMEMBERED):
        self.layouts, self.remember = layouts, remember
        self.known: dict[str, Layout | None] = {}

    def layout(self, mark: str, paths: set[str]) -> Layout | None:
        if mark not in self.known:
            if len(self.known) >= self.remember:
                self.known.clear()
            fitting = [x for x in self.layouts if all(any(p in paths for p in either) for either in x.needs)]
            self.known[mark] = max(fitting, key=lambda x: len(x.needs), default=None)
        return self.known[mark]

    def turns(self, text: str | None) -> tuple[str, str, list[tuple[str, str]]]:
        """Fingerprint, name of the layout, and the turns as role and text; no name if no mapping fits or the text is
        no JSON."""
        try:
            record = json.loads(text or "")
            paths = set(field_paths(record))
        except (ValueError, RecursionError):
            return "", "", []
        mark = fingerprint(paths)
        layout = self.layout(mark, paths)
        if layout is None:
            return mark, "", []
        found = []
        for kind in layout.turns:
            for own in _values(record, kind.each) if kind.each else [record]:
                texts = ["".join(map(_plain, leaves)) for leaves in (_leaves(own, p) for p in kind.texts) if leaves]
                if kind.fixed and not texts:
                    continue
                role = kind.fixed or "".join(map(_plain, _leaves(own, kind.role)))
                found.append((layout.roles.get(role, role), "\n\n".join(t for t in texts if t)))
        return mark, layout.name, found


def _values(value: Any, path: str) -> list[Any]:
    """What stands at a path."""
    found = [value]
    for step in path.split(".") if path else []:
        name = step.rstrip("[]")
        found = [v[name] for v in found if isinstance(v, dict) and name in v]
        for _ in range(step.count("[]")):
            found = [inner for v in found if isinstance(v, list) for inner in v]
    return found


def _leaves(value: Any, path: str) -> list[Any]:
    return [v for v in _values(value, path) if not isinstance(v, dict | list)]


def _plain(leaf: Any) -> str:
    """Text as it is, null as nothing, numbers and truth values as JSON."""
    return leaf if isinstance(leaf, str) else "" if leaf is None else json.dumps(leaf)


def canonical(
    records: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    record_col: str = "record",
    layouts: Sequence[Layout] = LAYOUTS,
) -> DataFrame:
    """The turns of records of mixed layouts: conv_id, turn, part, role, text, layout, fingerprint.

    A record is JSON text in ``record_col``; ``id_col`` says to which conversation it belongs and ``turn_col`` its place
    there. Both are integral. A record of several turns numbers them by ``part``. A null role or text is empty. A record
    that no layout fits, or that is no JSON, gives one row with null part, role, text and layout; ``layouts_found`` says
    how many those are. Repeated records give repeated turns, an empty table an empty one; other columns are not read.
    There is no shuffle, and memory grows with the longest record only.
    """
    ship(records.sparkSession)
    schema = "conv_id long, turn long, part int, role string, text string, layout string, fingerprint string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        converter = Converter(layouts)
        for batch in batches:
            for piece in in_pieces(batch, "record"):
                rows = []
                ids, turns, texts = (piece.column(name).to_pylist() for name in ("conv_id", "turn", "record"))
                for conv, turn, text in zip(ids, turns, texts):
                    mark, name, found = converter.turns(text)
                    rows += [(conv, turn, part, *own, name, mark) for part, own in enumerate(found)]
                    if not name:
                        rows.append((conv, turn, None, None, None, None, mark))
                columns = zip(*rows) if rows else [()] * len(kinds)
                yield arrow_rows(schema, {n: pa.array(c, k) for (n, k), c in zip(kinds.items(), columns)})

    text, whole = pa.string(), pa.int64()
    kinds = dict(conv_id=whole, turn=whole, part=pa.int32(), role=text, text=text, layout=text, fingerprint=text)
    keys = [F.col(f"`{name}`").cast("long").alias(own) for name, own in ((id_col, "conv_id"), (turn_col, "turn"))]
    return records.select(*keys, F.col(f"`{record_col}`").cast("string").alias("record")).mapInArrow(run, schema)


def layouts_found(turns: DataFrame) -> DataFrame:
    """Per fingerprint and layout the records that have it; layout is null for those that none fits."""
    firsts = turns.where(F.coalesce(F.col("part"), F.lit(0)) == 0)
    return firsts.groupBy("fingerprint", "layout").agg(F.count(F.lit(1)).alias("records"))


def _marked(text: Column) -> Column:
    """A text without anything that could pass for a mark: ``<``, backslashes and ``|`` get one backslash more."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def _role(role: Column) -> Column:
    """A role has no line feed either."""
    return _marked(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unmarked(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unmarked_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda found: "\n" if found[1] == "n" else found[1], unmarked(role))


def formatted(turns: DataFrame, trained: str = ASSISTANT) -> DataFrame:
    """A piece of text per turn: conv_id, turn, part, piece, loss_start, loss_end.

    The pieces of a conversation, in order of turn, part and piece, are its formatted text; so turns that tie go by
    role, then text. The characters of a piece from loss_start to before loss_end are under the loss mask: the text, still
    escaped, of every turn of role ``trained``; both are null for other turns. A null role or text counts as empty. Rows
    of records that no layout fits have no piece. A projection: no shuffle, and nothing holds a whole conversation.
    """
    role, text = _role(F.coalesce("role", F.lit(""))), _marked(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    is_trained = F.coalesce(F.col("role") == trained, F.lit(False))
    rows = turns.where(F.col("layout").isNotNull()).select(
        "conv_id", "turn", "part", is_trained.alias("is_trained"), head.alias("head"), text.alias("marked")
    )
    start = F.length("head")
    return rows.select(
        "conv_id",
        "turn",
        "part",
        F.concat("head", "marked", F.lit(f"{END}\n")).alias("piece"),
        F.when(F.col("is_trained"), start).alias("loss_start"),
        F.when(F.col("is_trained"), start + F.length("marked")).alias("loss_end"),
    )


class Reader:
    """Reads the formatted text of one conversation, piece by piece, wherever it was cut."""

    def __init__(self) -> None:
        self.rest, self.turns, self.chars, self.loss_chars = "", 0, 0, 0
        self.turns_digest, self.loss_digest = hashlib.sha256(), hashlib.sha256()

    def read(self, piece: str, start: int | None, end: int | None) -> list[tuple[str, str]]:
        """The turns that end in this piece."""
        self.chars += len(piece)
        if start is not None:
            trained = unmarked(piece[start:end])
            self.loss_chars += len(trained)
            self.loss_digest.update(trained.encode())
        found = []
        *whole, self.rest = (self.rest + piece).split(f"{END}\n")
        for turn in whole:
            role, _, text = turn.removeprefix(START).partition("\n")
            found.append((unmarked_role(role), unmarked(text)))
            self.turns_digest.update(f"{found[-1][0]}\n{found[-1][1]}\n".encode())
        self.turns += len(found)
        return found

    def row(self) -> tuple[int, str, int, str, int]:
        return self.turns, self.turns_digest.hexdigest(), self.loss_chars, self.loss_digest.hexdigest(), self.chars


def read_back(pieces: DataFrame) -> DataFrame:
    """What formatted texts hold, read from them alone: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars; a row per conversation, null being one.

    Digests of a conversation need its pieces in order: they are dealt by conversation, sorted with spill, and read as a
    stream. A task holds one batch and one turn, however long its conversations are; one very long conversation is
    read by one task, since a digest can only be taken in order.
    """
    ship(pieces.sparkSession)
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, current, done = None, None, []

        def finished() -> pa.RecordBatch:
            text, whole = pa.string(), pa.int64()
            kinds = (whole, whole, text, whole, text, whole)
            names = [part.split()[0] for part in schema.split(", ")]
            return arrow_rows(schema, {n: pa.array(c, k) for n, c, k in zip(names, zip(*done), kinds)})

        for batch in batches:
            for part in in_pieces(batch, "piece"):
                names = ("conv_id", "piece", "loss_start", "loss_end")
                for conv, piece, start, end in zip(*(part.column(name).to_pylist() for name in names)):
                    if reader is None or conv != current:
                        if reader is not None:
                            done.append((current, *reader.row()))
                        reader, current = Reader(), conv
                    reader.read(piece, start, end)
                if len(done) > 1000:
                    yield finished()
                    done = []
        if reader is not None:
            done.append((current, *reader.row()))
            yield finished()

    order = ["conv_id", "turn", "part", "piece"]
    sorted_pieces = pieces.repartition("conv_id").sortWithinPartitions(*order)
    return sorted_pieces.select("conv_id", "piece", "loss_start", "loss_end").mapInArrow(run, schema)
