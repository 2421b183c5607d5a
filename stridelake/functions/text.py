"""Prompts, token arrays, identifiers and formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stridelake.functions import vectors as V


def strip(x: Column) -> Column:
    """Without white space at both ends, of any kind."""
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def clean_prompt(x: Column) -> Column:
    """Stripped; underscores and line ends become spaces; case is kept."""
    return F.translate(strip(x), "_\n", "  ")


def clean_prompt_lower(x: Column) -> Column:
    """Lower case, stripped; underscores become spaces; line ends stay."""
    return F.translate(strip(F.lower(x)), "_", " ")


def prompt_with_state(prompt: Column, bins: Column, action_mark: bool = True) -> Column:
    """`Task: p, State: b b b;` and a new line, then `Action: ` if asked for."""
    state = F.array_join(F.transform(bins, lambda v: v.cast("string")), " ")
    return F.concat(F.lit("Task: "), prompt, F.lit(", State: "), state, F.lit(";\nAction: " if action_mark else ";\n"))


def padded_tokens(tokens: Column, length: int) -> Column:
    """Struct of ids (cut or padded with 0) and mask (true on ids)."""
    ids = F.slice(V.pad_to(tokens, length, 0), 1, length)
    mask = F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: i < F.size(tokens))
    return F.struct(F.transform(ids, lambda v: v.cast("int")).alias("ids"), mask.alias("mask"))


def prefix_postfix_tokens(prefix: Column, postfix: Column, length: int) -> Column:
    """Struct of ids, mask, ar_mask (0 on the prefix, 1 after) and loss_mask (true on the postfix), all of one
    length: cut, or padded with 0 and false."""
    tokens = F.concat(prefix, postfix)
    n, at = F.size(tokens), F.sequence(F.lit(0), F.lit(length - 1))
    p = padded_tokens(tokens, length)
    later = lambda i: (i >= F.size(prefix)) & (i < n)
    return F.struct(p["ids"].alias("ids"), p["mask"].alias("mask"), F.transform(at, lambda i: later(i).cast("int")).alias("ar_mask"), F.transform(at, later).alias("loss_mask"))


def next_tokens(tokens: Column) -> Column:
    """Targets: the input without its first element."""
    return F.slice(tokens, 2, F.size(tokens))


def action_text(decoded: Column) -> Column:
    """What stands between `Action: ` and a vertical bar; null without the mark."""
    return F.when(F.contains(decoded, F.lit("Action: ")), strip(F.split(F.element_at(F.split(decoded, "Action: ", 2), 2), r"\|", 2)[0]))


def flip_token(token: Column, vocabulary: int, reserved: int = 128) -> Column:
    """Action ids at the vocabulary's end, counted backwards; its own inverse."""
    return F.lit(vocabulary - 1 - reserved) - token


def decode_bins(tokens: Column, n_bins: int, horizon: int, dim: int) -> Column:
    """Rows of token / n_bins * 2 - 1; zeros when there are too few tokens."""
    row = lambda k: F.transform(F.slice(tokens, k * dim + 1, dim), lambda t: t / float(n_bins) * 2 - 1)
    rows = F.transform(F.sequence(F.lit(0), F.lit(horizon - 1)), row)
    zeros = F.array_repeat(F.array_repeat(F.lit(0.0), dim), horizon)
    return F.when(F.size(tokens) >= horizon * dim, rows).otherwise(zeros)


def digits_to_token(digits: Column, bases: Sequence[int]) -> Column:
    """Mixed radix: the first digit is the least significant."""
    places, p = [], 1
    for b in bases:
        places.append(p)
        p *= b
    return F.aggregate(F.zip_with(digits, F.array(*[F.lit(x) for x in places]), lambda d, x: d * x), F.lit(0).cast("long"), lambda a, v: a + v)


def token_to_digits(token: Column, bases: Sequence[int]) -> Column:
    out, p = [], 1
    for b in bases:
        out.append(F.pmod(F.floor(token / F.lit(p)), F.lit(b)).cast("int"))
        p *= b
    return F.array(*out)


def step_id(folder: Column, file: Column, step: Column) -> Column:
    return F.concat_ws("--", folder, file, step.cast("string"))


def episode_id(file_name: Column) -> Column:
    """What stands after the last underscore of the part before the first dot."""
    return F.substring_index(F.substring_index(file_name, ".", 1), "_", -1)


def numbered(name: Column, prefix: str = "out_") -> Column:
    """The number in `out_12...`; null without one."""
    return F.when(name.rlike(f"{prefix}[0-9]+"), F.regexp_extract(name, f"{prefix}([0-9]+)", 1).cast("int"))


def outcome_name(task: Column, success: Column) -> Column:
    return F.concat(F.translate(task, " ", "_"), F.lit("_"), F.when(success, "success").otherwise("failure"))


def success_value(answer: Column) -> Column:
    """y is 1, n is 0, a number from 0 to 100 is a percentage; anything else is null."""
    a = F.lower(strip(answer))
    number = F.when(a.rlike(r"^[0-9]+(\.[0-9]+)?$"), a.cast("double") / 100)
    return F.when(a == "y", 1.0).when(a == "n", 0.0).when(number.between(0, 1), number)


def from_bytes(x: Column) -> Column:
    return F.decode(x, "UTF-8")


def day_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy_MM_dd_HH:mm:ss")


def clock_stamp(ts: Column) -> Column:
    return F.date_format(ts, "hh:mma_MMMM_dd_yyyy")
