"""Chat formatting: layouts found by schema fingerprints, one reversible template."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Control strings of common chat templates, which must not be read as
# such inside texts.
CONTROL_STRINGS = (
    "<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<start_of_turn>", "<end_of_turn>",
)
#: A part of a formatted conversation ends with the turn that reaches so many characters.
PART_CHARS = 1_000_000

_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL_STRINGS))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    """Doubles backslashes and puts one behind the first character of control strings."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its escaped text starts and ends."""
    head, body = f"<|turn|>{escape(role)}<|text|>", escape(text)
    return f"{head}{body}<|end|>\n", len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of all turns of a formatted text."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def field_paths(value, path: str = "") -> set[str]:
    """The nested field paths of a record; list items share the path ``[]``."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{path}.{k}" if path else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union({f"{path}[]"}, *(field_paths(v, f"{path}[]") for v in value))
    return {path}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode("utf-8", "surrogatepass")).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """How records with just these field paths become turns.

    ``turns`` are (role, field) in order; a role that starts with ``.`` is the field
    that holds it. With ``items`` they are fields of each item of that list.
    ``optional`` fields are left out when empty.
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...]
    items: str | None = None
    optional: tuple[str, ...] = ()
    roles: dict[str, str] = field(default_factory=dict)

    def read(self, record: dict) -> list[tuple[str, str]]:
        out = []
        for item in record[self.items] if self.items else [record]:
            for role, name in self.turns:
                text = _text(item.get(name))
                if text or name not in self.optional:
                    role = _text(item.get(role[1:])) if role.startswith(".") else role
                    out.append((self.roles.get(role, role), text))
        return out


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


_PEOPLE = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
MAPPINGS = (
    Mapping("turn rows", ("role", "text"), ((".role", "text"),)),
    Mapping("messages", ("messages[]", "messages[].role", "messages[].content"),
            ((".role", "content"),), "messages", roles=_PEOPLE),
    Mapping("speakers", ("conversations[]", "conversations[].from", "conversations[].value"),
            ((".from", "value"),), "conversations", roles=_PEOPLE),
    Mapping("instruction", ("instruction", "output"), (("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction with input", ("instruction", "input", "output"),
            (("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("input",)),
    Mapping("prompt and response", ("prompt", "response"), (("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt and completion", ("prompt", "completion"),
            (("user", "prompt"), ("assistant", "completion"))),
    Mapping("question and answer", ("question", "answer"), (("user", "question"), ("assistant", "answer"))),
    Mapping("system, prompt and response", ("system", "prompt", "response"),
            (("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
)

_TURNS = "conv_id long, turn long, seq int, layout string, role string, text string"


def canonical_turns(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Turns of ``records`` (conv_id, turn, record: JSON): conv_id, turn, seq, layout, role, text.

    The fingerprint of a record's field paths picks the mapping. A record whose layout is
    not known, or that is no JSON object, gives one row with a null layout and
    role and the record as its text, so nothing is lost. Null texts are empty.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = {fingerprint(m.paths): m for m in mappings}
        for batch in batches:
            rows = []
            for conv_id, turn, text in zip(batch["conv_id"], batch["turn"], batch["record"], strict=True):
                mapping, record = None, None
                try:
                    record = json.loads(text)
                    mapping = known.get(fingerprint(field_paths(record))) if isinstance(record, dict) else None
                except (TypeError, ValueError):
                    pass
                if mapping is None:
                    rows.append((conv_id, turn, 0, None, None, text))
                    continue
                for seq, (role, said) in enumerate(mapping.read(record)):
                    rows.append((conv_id, turn, seq, mapping.name, role, said))
            out = pd.DataFrame(rows, columns=["conv_id", "turn", "seq", "layout", "role", "text"])
            yield out.astype({"conv_id": "Int64", "turn": "Int64"})

    ids = [F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")]
    return records.select(*ids, "record").mapInPandas(read, _TURNS)


_PARTS = (
    "conv_id long, first_turn long, part long, formatted string, loss array<struct<start:int,end:int>>"
)


def format_conversations(
    turns: DataFrame, part_chars: int = PART_CHARS, trained_role: str = "assistant"
) -> DataFrame:
    """Conversations as formatted texts: conv_id, first_turn, part, formatted, loss.

    ``turns`` has conv_id, turn, seq, role, text and is ordered by turn, seq, role
    and text; nulls come first and null roles and texts are empty. ``loss`` are the
    places of the texts of ``trained_role`` in ``formatted``. Rows are range
    partitioned, so a conversation of any length is spread over tasks: it comes in
    parts, in the order of ``part``. Repeated rows are turns of their own.
    """
    order = ["conv_id", "turn", "seq", "role", "text"]
    spread = turns.select(*order).repartitionByRange("conv_id", "turn", "seq").sortWithinPartitions(*order)

    def render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, first, size, texts, loss = None, None, 0, [], []
        number = -1
        for batch in batches:
            rows = []
            ids = batch["conv_id"].astype("object").where(batch["conv_id"].notna(), None)
            for conv_id, turn, place, role, text in zip(
                ids, batch["turn"], batch["place"], batch["role"], batch["text"], strict=True
            ):
                if texts and (conv_id != conv or size >= part_chars):
                    rows.append((conv, first, number, "".join(texts), loss))
                    size, texts, loss = 0, [], []
                if not texts:
                    conv, first, number = conv_id, turn, place
                shown, start, end = render_turn(role or "", text or "")
                if role == trained_role:
                    loss.append({"start": size + start, "end": size + end})
                texts.append(shown)
                size += len(shown)
            if rows:
                yield _part_rows(rows)
        if texts:
            yield _part_rows([(conv, first, number, "".join(texts), loss)])

    return spread.withColumn("place", F.monotonically_increasing_id()).mapInPandas(render, _PARTS)


def _part_rows(rows) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conv_id", "first_turn", "part", "formatted", "loss"])
    return out.astype({"conv_id": "Int64", "first_turn": "Int64"})


def digest_conversations(parts: DataFrame) -> DataFrame:
    """What reading the formatted texts back gives, per conversation.

    conv_id, n_turns, turns_sha256 (over role, line end, text, line end of all turns),
    loss_chars and loss_sha256 (of all text under the mask, unescaped), formatted_chars.
    A digest takes its text in order, so a conversation's parts pass through one task, one
    at a time; nothing but the state of the two digests is held.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for batch in batches:
            rows = []
            ids = batch["conv_id"].astype("object").where(batch["conv_id"].notna(), None)
            for conv_id, formatted, loss in zip(ids, batch["formatted"], batch["loss"], strict=True):
                if state is None or state[0] != conv_id:
                    if state is not None:
                        rows.append(_digests(state))
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(formatted):
                    state[1] += 1
                    state[2].update(_bytes(f"{role}\n{text}\n"))
                for span in loss:
                    text = unescape(formatted[span["start"] : span["end"]])
                    state[3] += len(text)
                    state[4].update(_bytes(text))
                state[5] += len(formatted)
            if rows:
                yield _digest_rows(rows)
        if state is not None:
            yield _digest_rows([_digests(state)])

    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.select("conv_id", "formatted", "loss").mapInPandas(
        read,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    )


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _digests(state) -> tuple:
    conv_id, n, turns, chars, loss, formatted = state
    return conv_id, n, turns.hexdigest(), chars, loss.hexdigest(), formatted


def _digest_rows(rows) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    ])
    return out.astype({"conv_id": "Int64"})
