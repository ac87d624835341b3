"""Chat formatting of records in many layouts.

The nested field paths of a record are hashed; the fingerprint selects a declarative mapping to canonical turns (role, text).
A template then marks turns and escapes control strings inside texts, reversibly, with the spans of assistant text as loss mask.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, tidied

# Half a character of those beyond U+FFFF.
_HALF = re.compile("[\ud800-\udfff]")

# Other names of the roles.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns: a list of (role, path) for single fields, or the paths of a list of messages."""

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    each: tuple[str, str, str] | None = None  # list, role inside it, text inside it
    optional: frozenset[str] = field(default_factory=frozenset)
    renamed: bool = True  # roles get their canonical names

    def paths(self) -> set[str]:
        own = {p for _, p in self.fields}
        return own | ({f"{self.each[0]}[].{self.each[1]}", f"{self.each[0]}[].{self.each[2]}"} if self.each else set())


MAPPINGS = (
    Mapping("prompt", (("user", "prompt"), ("assistant", "completion"))),
    Mapping("question", (("system", "system_prompt"), ("user", "question"), ("assistant", "response")), optional=frozenset({"system_prompt"})),
    Mapping("instruction", (("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=frozenset({"input"})),
    Mapping("messages", each=("messages", "role", "content")),
    Mapping("conversations", each=("conversations", "from", "value")),
    Mapping("nested", each=("data.dialog", "speaker", "utterance")),
    Mapping("turns", each=("turns", "role", "text"), optional=frozenset({"turns[].role", "turns[].text"}), renamed=False),
)


# The layouts with a list of turns, whose roles stay as they are.
PLAIN = tuple(replace(m, renamed=False) for m in MAPPINGS if m.each)


def field_paths(value, at: str = "") -> Iterator[str]:
    """Paths of the leaves of a record; members of a list share one path. Nulls have none.

    A backslash tells a dot or bracket inside a key from those that a path is made of.
    """
    if isinstance(value, dict):
        for key, inner in value.items():
            own = re.sub(r"([\\.\[])", r"\\\1", str(key))
            yield from field_paths(inner, f"{at}.{own}" if at else own)
    elif isinstance(value, list):
        for inner in value:
            yield from field_paths(inner, f"{at}[]")
    elif value is not None:
        yield at


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


class Registry:
    """Mappings by the fingerprint of the paths they read, with or without their optional ones."""

    def __init__(self, mappings: tuple[Mapping, ...] = MAPPINGS):
        self.vocabulary = set().union(*(m.paths() for m in mappings))
        self.by_print: dict[str, Mapping] = {}
        for m in mappings:
            for k in range(len(m.optional) + 1):
                for out in itertools.combinations(sorted(m.optional), k):
                    if left := m.paths() - set(out):
                        self.by_print.setdefault(fingerprint(left), m)

    def mapping(self, record: dict) -> Mapping | None:
        """The mapping of a record; paths that no mapping reads do not count."""
        return self.by_print.get(fingerprint(p for p in field_paths(record) if p in self.vocabulary))

    def turns(self, record: dict) -> tuple[str | None, list[tuple[str, str]]]:
        """Name of the layout and the turns, roles of foreign layouts under their canonical names; (None, []) for an unknown layout."""
        found = self.mapping(record)
        if found is None:
            return None, []
        if found.each:
            inner = _at(record, found.each[0])
            rows = [m for m in inner if isinstance(m, dict)] if isinstance(inner, list) else []
            name = _role if found.renamed else _text
            return found.name, [(name(m.get(found.each[1])), _text(m.get(found.each[2]))) for m in rows]
        out: list[tuple[str, str]] = []
        for role, path in found.fields:
            text = _at(record, path)
            if text is None:
                continue
            if out and out[-1][0] == role and _text(text):  # instruction and input are one turn
                out[-1] = (role, f"{out[-1][1]}\n\n{_text(text)}")
            elif not (out and out[-1][0] == role):
                out.append((role, _text(text)))
        return found.name, out


def _at(record, path: str):
    for key in path.split("."):
        record = record.get(key) if isinstance(record, dict) else None
    return record


def _text(value) -> str:
    text = "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True)
    # JSON may spell half a character, which no text can hold
    return _HALF.sub("\ufffd", text)


def _integer(digits: str) -> int | str:
    return int(digits) if len(digits) < 4000 else digits


def read_record(text: str | None) -> dict:
    """A JSON object; anything else, and what cannot be read, is an empty one."""
    try:
        record = json.loads(text, parse_int=_integer) if text else {}
    except (ValueError, RecursionError):
        return {}
    return record if isinstance(record, dict) else {}


def _role(value) -> str:
    return ROLES.get(_text(value), _text(value))


# Control strings of the template, by role.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
_OTHER, _OTHER_END = "[ROLE ", "[/ROLE]"
_CONTROL = re.compile("|".join(re.escape(m) for m in (*itertools.chain(*MARKS.values()), _OTHER, _OTHER_END)))
_OPEN = re.compile("|".join(f"({re.escape(a)})" for a, _ in MARKS.values()) + r"|\[ROLE ((?:\\.|[^\\\]])*)\]", re.DOTALL)


def escape(text: str) -> str:
    """No control string is left in the result: a backslash splits each, and backslashes are doubled."""
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """The formatted conversation, and starts and ends of its assistant texts in code points."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        start, end = MARKS.get(role) or (_OTHER + role.replace("\\", "\\\\").replace("]", "\\]") + "]", _OTHER_END)
        body = escape(text)
        if role == "assistant":
            starts.append(at + len(start))
            ends.append(at + len(start) + len(body))
        parts += [start, body, end]
        at += len(start) + len(body) + len(end)
    return "".join(parts), starts, ends


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    out, at, names = [], 0, list(MARKS)
    while at < len(formatted):
        opened = _OPEN.match(formatted, at)
        if not opened:
            raise ValueError(f"no turn begins at {at}")
        known = opened.lastindex <= len(names)
        role = names[opened.lastindex - 1] if known else unescape(opened[len(names) + 1])
        close = MARKS[role][1] if known else _OTHER_END
        end = formatted.index(close, opened.end())
        out.append((role, unescape(formatted[opened.end():end])))
        at = end + len(close)
    return out


def conversation_records(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         layouts: tuple[Mapping, ...] = PLAIN[-1:]) -> DataFrame:
    """conv_id, record: rows of turns as records. Rows without a turn number come first, equal ones by role and text.

    A conversation's layout is one of ``layouts`` (mappings of a list of turns), dealt by a hash of its id. A conversation becomes
    one text, so its turns meet in one row; conversations are spread by their ids.
    """
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    turns = F.array_sort(F.collect_list(one), lambda a, b: _compare(a, b))
    gathered = rows.groupBy(F.col(conv).alias("conv_id")).agg(turns.alias("turns"))
    records = [F.to_json(_laid_out(F.col("turns"), m)) for m in layouts]
    which = F.pmod(F.xxhash64("conv_id"), F.lit(len(layouts)))
    record = F.coalesce(*[F.when(which == k, r) for k, r in enumerate(records)])
    return gathered.select("conv_id", record.alias("record"))


def _laid_out(turns: Column, layout: Mapping) -> Column:
    """Turns as a mapping of a list of turns reads them."""
    where, role, text = layout.each
    out = F.transform(turns, lambda t: F.struct(t["role"].alias(role), t["text"].alias(text)))
    for key in reversed(where.split(".")):
        out = F.struct(out.alias(key))
    return out


def _compare(a: Column, b: Column) -> Column:
    def by(x: Column, y: Column, rest: Column) -> Column:
        return F.when(x < y, -1).when(x > y, 1).otherwise(rest)
    none = F.when(a["turn"].isNull() & b["turn"].isNotNull(), -1).when(a["turn"].isNotNull() & b["turn"].isNull(), 1)
    return none.otherwise(by(a["turn"], b["turn"], by(a["role"], b["role"], by(a["text"], b["text"], F.lit(0)))))


_OUT = [("layout", pa.string()), ("formatted", pa.string()), ("loss_starts", pa.list_(pa.int64())), ("loss_ends", pa.list_(pa.int64()))]


def format_records(records: DataFrame, id_col: str, record_col: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``id_col``, layout, formatted, loss_starts, loss_ends of JSON records in any layout that a mapping knows.

    A record that is null, no JSON object, nested too deeply, or of an unknown layout has a null layout and an empty text; no
    record fails. Half a character becomes U+FFFD. Repeated records are formatted each; other columns are not read.
    """
    kind = records.schema[id_col].dataType.simpleString()

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        registry = Registry(mappings)
        for batch in batches:
            schema = pa.schema([("id", batch.schema.field("id").type), *_OUT])

            def rows():
                for key, text in zip(batch.column("id").to_pylist(), batch.column("record").to_pylist()):
                    try:
                        layout, turns = registry.turns(read_record(text))
                    except RecursionError:  # nested deeper than its paths can be followed
                        layout, turns = None, []
                    yield key, layout, *render(turns)
            yield from arrow_batches(rows(), schema, weight=lambda r: len(r[2]))
    read = records.select(F.col(id_col).alias("id"), F.col(record_col).alias("record"))
    return read.mapInArrow(tidied(convert), f"id {kind}, layout string, formatted string, loss_starts array<long>, loss_ends array<long>").withColumnRenamed("id", id_col)


def read_back(formatted: DataFrame, id_col: str) -> DataFrame:
    """``id_col``, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all from the formatted text and its mask."""
    kind = formatted.schema[id_col].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([("id", batch.schema.field("id").type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                                ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

            def rows():
                for key, text, starts, ends in zip(*[batch.column(c).to_pylist() for c in ("id", "formatted", "loss_starts", "loss_ends")]):
                    turns = parse(text)
                    loss = "".join(unescape(text[a:b]) for a, b in zip(starts, ends))
                    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
                    yield (key, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text))
            yield from arrow_batches(rows(), schema)
    read = formatted.select(F.col(id_col).alias("id"), "formatted", "loss_starts", "loss_ends")
    return read.mapInArrow(tidied(digest), f"id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").withColumnRenamed("id", id_col)
