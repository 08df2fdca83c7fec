"""Chat formatting at token level (operator 7).

Every turn is encoded by itself and spliced between reserved ids that no text can produce, so
content can never end a turn.  In the rendered text the reserved ids become control strings,
and control strings inside content are escaped with a backslash, reversibly.  The loss mask is
the prefix sum of +1 where an assistant's content begins and -1 where it ends.

A null text is empty, a null role is the empty role.  Turns of one conversation are ordered by
turn (nulls first), then role and text, so repeated rows stay and ties have one order.  Turns
are encoded where they are read; a conversation's turns meet sorted in one stream that keeps a
running digest only, so its length does not matter for memory.  Other columns are ignored, clashing
names included.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.support import ship

HEAD, TURN_END = "### ", " </turn>\n"
#: Control strings that content must not hold unescaped.
CONTROLS = ("###", "</turn>")


def escape(text: str) -> str:
    """A backslash before every backslash and control string."""
    text = text.replace("\\", "\\\\")
    for control in CONTROLS:
        text = text.replace(control, "\\" + control)
    return text


def unescape(text: str) -> str:
    out, i = [], 0
    while (j := text.find("\\", i)) >= 0:
        out += (text[i:j], text[j + 1 : j + 2])
        i = j + 2
    return "".join(out) + text[i:]


class Reserved:
    """Ids above the vocabulary: one opens a turn, one follows its role, one ends it."""

    def __init__(self, vocabulary_size: int):
        self.open, self.role_end, self.end = range(vocabulary_size, vocabulary_size + 3)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True  # their strings in content are ordinary text
    return found


def assemble(role_ids: list[int], text_ids: list[int], assistant: bool, reserved: Reserved) -> tuple[np.ndarray, np.ndarray]:
    """Ids of one turn, and its loss mask as a prefix sum of the segment borders."""
    ids = np.array([reserved.open, *role_ids, reserved.role_end, *text_ids, reserved.end], np.int32)
    step = np.zeros(len(ids) + 1, np.int32)
    first = len(role_ids) + 2
    if assistant:
        step[first] += 1
        step[first + len(text_ids)] -= 1
    return ids, np.cumsum(step[:-1]).astype(bool)


def render(ids: np.ndarray, mask: np.ndarray, tok, reserved: Reserved) -> tuple[str, str, str, str]:
    """Formatted text of a turn and, read back from the ids: role, text, text under the mask."""
    role_end = int(np.flatnonzero(ids == reserved.role_end)[0])
    content, masked = ids[role_end + 1 : -1], ids[mask]
    role = tok.decode(ids[1:role_end].tolist(), skip_special_tokens=False)
    text = tok.decode(content.tolist(), skip_special_tokens=False)
    loss = "" if not len(masked) else text if np.array_equal(masked, content) else tok.decode(masked.tolist(), skip_special_tokens=False)
    plain = unescape(text)
    return f"{HEAD}{role}: {text}{TURN_END}", unescape(role), plain, plain if loss is text else unescape(loss)


def format_turns(turns: DataFrame, vocabulary: str, shown: bool = True) -> DataFrame:
    """One row per turn: token ids, loss mask and, if wanted, formatted text, beside conv_id and turn."""
    ship(turns.sparkSession)

    def run(batches):
        tok = tokenizer(vocabulary)
        reserved = Reserved(tok.get_vocab_size())
        for batch in batches:
            roles = [r or "" for r in batch.column(2).to_pylist()]
            texts = [t or "" for t in batch.column(3).to_pylist()]
            role_ids = {r: tok.encode(escape(r), add_special_tokens=False).ids for r in set(roles)}
            distinct = list(dict.fromkeys(texts))
            coded = tok.encode_batch([escape(t) for t in distinct], add_special_tokens=False)
            text_ids = {t: code.ids for t, code in zip(distinct, coded, strict=True)}
            ids, masks, formatted = [], [], []
            for role, text in zip(roles, texts, strict=True):
                i, m = assemble(role_ids[role], text_ids[text], role == "assistant", reserved)
                ids.append(i.tobytes())
                masks.append(np.packbits(m).tobytes())
                formatted.append(render(i, m, tok, reserved)[0] if shown else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(roles, pa.string()), pa.array(texts, pa.string()),
                 pa.array(ids, pa.binary()), pa.array(masks, pa.binary()), pa.array(formatted, pa.string())],
                names=["conv_id", "turn", "role", "text", "ids", "mask", "formatted"],
            )

    kinds = dict(turns.dtypes)
    return turns.select("conv_id", "turn", "role", "text").mapInArrow(
        run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, text string, "
        "ids binary, mask binary, formatted string",
    )


def conversation_digests(turns: DataFrame, vocabulary: str) -> DataFrame:
    """Per conversation, read back from the token ids: turns, loss text and formatted length."""
    coded = format_turns(turns, vocabulary, shown=False)
    # The order of ties is settled by role and text, then only the ids travel on.
    ordered = coded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        tok = tokenizer(vocabulary)
        reserved = Reserved(tok.get_vocab_size())
        state, rows = None, []

        def close():
            rows.append((state["id"], state["n"], state["all"].hexdigest(), state["loss_n"],
                         state["loss"].hexdigest(), state["shown"]))

        for batch in batches:
            for conv, raw, packed in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True
            ):
                if state is None or state["id"] != conv:
                    if state is not None:
                        close()
                    state = {"id": conv, "n": 0, "all": hashlib.sha256(), "loss_n": 0, "loss": hashlib.sha256(), "shown": 0}
                ids = np.frombuffer(raw, np.int32)
                mask = np.unpackbits(np.frombuffer(packed, np.uint8), count=len(ids)).astype(bool)
                shown, role, text, loss = render(ids, mask, tok, reserved)
                state["n"] += 1
                state["all"].update(f"{role}\n{text}\n".encode())
                state["loss_n"] += len(loss)
                state["loss"].update(loss.encode())
                state["shown"] += len(shown)
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)
            rows.clear()
        if state is not None:
            close()
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)

    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    conv_kind = dict(turns.dtypes)["conv_id"]
    schema = pa.schema([("conv_id", kinds[conv_kind]), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    return ordered.select("conv_id", "ids", "mask").mapInArrow(
        run, f"conv_id {conv_kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    )


def with_control_case(turns: DataFrame) -> DataFrame:
    """The turns plus conversation -7, whose two texts hold the template's own control strings."""
    said = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    more = turns.sparkSession.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(more).withColumn("text", F.coalesce("text", F.lit("")))
