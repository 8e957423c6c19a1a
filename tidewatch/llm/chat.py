"""Chat formatting with typed content parts, and reading the result back.

A turn is a list of parts: text, or an image, audio clip or document that is only referred to. A
visitor turns the parts of a conversation into one string, in order: text is escaped, an
attachment becomes a numbered placeholder, and its reference and the tokens it expands to are
recorded beside the string. Texts of the roles to learn from are under the loss mask.

    ### user: What is <image:1>?</turn>
    ### assistant: A boat.</turn>

In texts and roles a backslash starts an escape, so the control strings of the template
cannot appear in them: ``\\\\`` is a backslash, ``\\l`` is <, ``\\h`` is #, ``\\c`` is a colon
and ``\\n`` a line feed (the last two in roles only).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, MIDDLE, END = "### ", ": ", "</turn>\n"
LEARNED = ("assistant",)
#: Tokens that an attachment without a count of its own expands to.
EXPANDS = {"image": 256, "audio": 128, "document": 512}
PART = "struct<type:string,text:string,ref:string,tokens:long>"

_TEXT = {"\\": "\\\\", "<": "\\l", "#": "\\h"}
_ROLE = _TEXT | {":": "\\c", "\n": "\\n"}
_PLAIN = {v: k for k, v in _ROLE.items()}


def escape(text: str, role: bool = False) -> str:
    codes = _ROLE if role else _TEXT
    return re.sub(r"[\\<#:\n]" if role else r"[\\<#]", lambda m: codes[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\.", lambda m: _PLAIN[m[0]], text, flags=re.DOTALL)


@dataclass
class Visitor:
    """Collects the output of a conversation; ``visit`` goes to the method of a part's type."""
    learned: tuple[str, ...] = LEARNED
    out: list[str] = field(default_factory=list)
    size: int = 0
    mask: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[tuple[int, str, str, int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.out.append(text)
        self.size += len(text)

    def visit_turn(self, role: str | None, parts: list[dict]) -> None:
        self.write(START + escape(role or "", role=True) + MIDDLE)
        for part in parts:
            begin = self.size
            self.visit(part)
            # placeholders stand for what the model is given, not for what it says
            if role in self.learned and part["type"] == "text" and self.size > begin:
                self.mask.append((begin, self.size))
        self.write(END)

    def visit(self, part: dict) -> None:
        kind = part["type"]
        visit: Callable[[dict], None] = (self.visit_text if kind == "text" else
                                         self.visit_attachment)
        if kind not in ("text", *EXPANDS):
            raise ValueError(f"unknown part type {kind!r}")
        visit(part)

    def visit_text(self, part: dict) -> None:
        self.write(escape(part["text"] or ""))

    def visit_attachment(self, part: dict) -> None:
        kind, tokens = part["type"], part["tokens"]
        known = tokens is not None and not pd.isna(tokens)
        self.attachments.append((len(self.attachments) + 1, kind, part["ref"] or "",
                                 int(tokens) if known else EXPANDS[kind]))
        self.write(f"<{kind}:{len(self.attachments)}>")


def text_parts(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, parts) of messages with a ``text`` column: one text part each."""
    part = F.struct(F.lit("text").alias("type"), F.col("text").cast("string").alias("text"),
                    F.lit(None).cast("string").alias("ref"),
                    F.lit(None).cast("long").alias("tokens"))
    return messages.select(F.col("conv_id").cast("long").alias("conv_id"),
                           F.col("turn").cast("long").alias("turn"),
                           F.col("role").cast("string").alias("role"),
                           F.array(part).cast(f"array<{PART}>").alias("parts"))


_FORMATTED = ("conv_id long, formatted string, mask array<struct<start:long,end:long>>, "
              "attachments array<struct<number:long,type:string,ref:string,tokens:long>>, "
              "attachment_tokens long")


def format_conversations(messages: DataFrame, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """One row per conversation: the string, its loss mask (code points), and its attachments.

    ``messages`` has conv_id, turn, role and parts (as ``text_parts`` gives them). Turns go by
    ``turn``, then role and parts; one without a number comes last. Defined cases: a null text or
    role is empty, a null list of parts is a turn without text, repeated rows are repeated turns,
    rows without conv_id make up one conversation, an empty table gives no rows, other columns are
    ignored, and a type that is not known is an error.
    """
    turn = F.struct(F.col("turn").isNull().alias("late"), "turn", "role",
                    F.to_json("parts").alias("order"), "parts")
    grouped = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for conv_id, turns in zip(frame["conv_id"], frame["turns"]):
                v = Visitor(learned)
                for t in turns:
                    v.visit_turn(t["role"], [] if t["parts"] is None else list(t["parts"]))
                rows.append((conv_id, "".join(v.out), [{"start": a, "end": b} for a, b in v.mask],
                             [dict(zip(("number", "type", "ref", "tokens"), a))
                              for a in v.attachments], sum(a[3] for a in v.attachments)))
            out = pd.DataFrame(rows, columns=["conv_id", "formatted", "mask", "attachments",
                                              "attachment_tokens"])
            out["conv_id"] = out["conv_id"].astype("Int64")
            yield out

    return grouped.mapInPandas(run, _FORMATTED)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn; placeholders stay in the text as they are."""
    turns = []
    for piece in formatted.split(END)[:-1]:
        role, text = piece[len(START):].split(MIDDLE, 1)
        turns.append((unescape(role), unescape(text)))
    return turns


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted strings and masks say: turns, and the text to learn from."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for conv_id, text, mask in zip(frame["conv_id"], frame["formatted"], frame["mask"]):
                turns = read_turns(text)
                learned = "".join(unescape(text[m["start"]:m["end"]]) for m in mask)
                rows.append((
                    conv_id, len(turns), _sha("".join(f"{r}\n{t}\n" for r, t in turns)),
                    len(learned), _sha(learned), len(text)))
            out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars",
                                              "loss_sha256", "formatted_chars"])
            out["conv_id"] = out["conv_id"].astype("Int64")
            yield out

    return formatted.select("conv_id", "formatted", "mask").mapInPandas(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
             "loss_sha256 string, formatted_chars long")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
