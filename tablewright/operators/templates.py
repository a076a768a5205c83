"""Prompt templates rendered as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions import text as tx

SYSTEM_MESSAGE = "You are a helpful assistant."
VICUNA_SYSTEM = (
    "A chat between a curious user and an artificial intelligence assistant. "
    "The assistant gives helpful, detailed, and polite answers to the user's questions."
)

# The markup of each chat format, {user} being the user turn. All
# training templates end with the answer and its closing mark.
TRAINING: dict[str, str] = {
    "chatml": (
        "<|im_start|>system\n{system}<|im_end|>\n"
        "<|im_start|>user\n{user}<|im_end|>\n"
        "<|im_start|>assistant\n{output}<|im_end|>"
    ),
    "chatml_legacy": (
        "im_start>system\n{system}im_end>\nim_start>user\n{user}im_end>\nim_start>assistant\n{output}im_end>"
    ),
    "llama3": (
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n{system}<|eot_id|>"
        "<|start_header_id|>user<|end_header_id|>\n\n{user}<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\n{output}<|eot_id|>"
    ),
    "vicuna": "{system}\n\nUSER: {user}\nASSISTANT: {output}",
    "zephyr": "<|system|>\n{system}</s>\n<|user|>\n{user}</s>\n<|assistant|>\n{output}</s>",
    "zephyr_legacy": "<|system|>\n{system}im_end>\n<|user|>\n{user}im_end>\n<|assistant|>\n{output}im_end>",
}

# The answer is left out, and zephyr closes its turns differently.
INFERENCE: dict[str, str] = {
    "chatml": "<|im_start|>system\n{system}<|im_end|>\n<|im_start|>user\n{user}<|im_end|>\n<|im_start|>assistant\n",
    "chatml_legacy": "im_start>system\n{system}im_end>\nim_start>user\n{user}im_end>\nim_start>assistant\n",
    "llama3": (
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n{system}<|eot_id|>"
        "<|start_header_id|>user<|end_header_id|>\n\n{user}<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\n"
    ),
    "vicuna": VICUNA_SYSTEM + "\n\nUSER: {user}\nASSISTANT: ",
    "zephyr": "<|system|>\n{system}<|end|>\n<|user|>\n{user}<|end|>\n<|assistant|>\n",
}

# Formats that differ in shape when there is an input.
ALPACA = "### Instruction:\n{instruction}\n\n### Response:\n{output}"
ALPACA_WITH_INPUT = "### Instruction:\n{instruction}\n\n### Input:\n{input}\n\n### Response:\n{output}"
CUSTOM = "{instruction}\n\n{output}"
CUSTOM_WITH_INPUT = "{instruction}\n\n{input}\n\n{output}"

TEMPLATES = ("alpaca", "plain", "custom", *TRAINING)


def render(template: str, fields: Mapping[str, Column]) -> Column:
    """A template with named placeholders as one concatenation."""
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            if name not in fields:
                raise ValueError(f"Unknown placeholder {{{name}}}. Available: {sorted(fields)}")
            parts.append(fields[name])
    return F.concat(*parts) if parts else F.lit("")


def _field(name: str, trimmed: bool) -> Column:
    value = F.coalesce(F.col(name), F.lit(""))
    return tx.strip(value) if trimmed else value


def _fields(system: str, keys: Mapping[str, str], trimmed: bool, columns: Sequence[str] | None) -> dict[str, Column]:
    names = {k: keys.get(k, k) for k in ("instruction", "input", "output")}
    fields = {
        k: _field(c, trimmed) if columns is None or c in columns else F.lit("")
        for k, c in names.items()
    }
    has_input = fields["input"] != ""
    fields["user"] = F.when(
        has_input, F.concat(fields["instruction"], F.lit("\n\n"), fields["input"])
    ).otherwise(fields["instruction"])
    fields["system"] = F.lit(system)
    return fields


def prompt(
    name: str,
    system: str | None = None,
    eos: str = "",
    custom: str = CUSTOM,
    custom_with_input: str | None = None,
    keys: Mapping[str, str] | None = None,
    columns: Sequence[str] | None = None,
) -> Column:
    """The training text of one record; fields are stripped, null counts as empty."""
    keys = keys or {}
    if name not in TEMPLATES:
        raise ValueError(f"Unknown formatter: {name}. Available: {list(TEMPLATES)}")
    if name == "plain":
        return F.concat(F.coalesce(F.col(keys.get("text", "text")), F.lit("")), F.lit(eos))
    system = system or (VICUNA_SYSTEM if name == "vicuna" else SYSTEM_MESSAGE)
    fields = _fields(system, keys, True, columns)
    if name in TRAINING:
        body = render(TRAINING[name], fields)
    else:
        if name == "alpaca":
            custom, custom_with_input = ALPACA, ALPACA_WITH_INPUT
        elif custom_with_input is None:
            custom_with_input = CUSTOM_WITH_INPUT if custom == CUSTOM else custom
        body = F.when(fields["input"] != "", render(custom_with_input, fields)).otherwise(render(custom, fields))
    return F.concat(body, F.lit(eos)) if eos else body


def format_table(
    df: DataFrame,
    template: str | None = None,
    default: str | None = None,
    keep_columns: bool = False,
    template_column: str | None = None,
    ids: Sequence[str] = ("row_id",),
    **options,
) -> DataFrame:
    """``text`` for every record, by one template or by the one each row names.

    An unknown name is an error, or falls back to ``default`` where one is given.
    """
    options.setdefault("columns", df.columns)
    if template_column is None:
        if template not in TEMPLATES and default is not None:
            template = default
        body = prompt(template, **options)
    else:
        usable = [t for t in TEMPLATES if t != "plain"]
        choice = F.col(template_column)
        other = (
            prompt(default, **options)
            if default
            else F.raise_error(F.concat(F.lit("Unknown formatter: "), F.coalesce(choice, F.lit("null"))))
        )
        body = None
        for t in usable:
            branch = prompt(t, **options)
            body = F.when(choice == t, branch) if body is None else body.when(choice == t, branch)
        body = body.otherwise(other)
    kept = [c for c in df.columns if c != "text"] if keep_columns else [c for c in ids if c in df.columns]
    return df.select(*kept, body.alias("text"))


def inference_prompt(
    name: str = "alpaca",
    system: str = SYSTEM_MESSAGE,
    template: str | None = None,
    template_with_input: str | None = None,
    columns: Sequence[str] | None = None,
) -> Column:
    """A prompt that ends where the answer starts; fields are taken as they are."""
    fields = _fields(system, {}, False, columns)
    has_input = fields["input"] != ""
    if template is not None or template_with_input is not None:
        plain = render(template or "", fields)
        return F.when(has_input, render(template_with_input or template, fields)).otherwise(plain)
    if name in INFERENCE:
        return render(INFERENCE[name], fields)
    without = ALPACA.removesuffix("{output}")
    with_input = ALPACA_WITH_INPUT.removesuffix("{output}")
    return F.when(has_input, render(with_input, fields)).otherwise(render(without, fields))


def render_chat(df: DataFrame, conv: str = "conv_id", add_generation_prompt: bool = True) -> DataFrame:
    """One text per conversation, a ``role: content`` line per turn.

    A conversation becomes one value, so it has to fit one value by definition.
    """
    turns = F.array_sort(
        F.collect_list(F.struct("turn", F.concat(F.col("role"), F.lit(": "), F.col("text"), F.lit("\n")).alias("line")))
    )
    tail = "assistant: " if add_generation_prompt else ""
    return df.groupBy(conv).agg(
        F.concat(F.array_join(F.transform(turns, lambda t: t["line"]), ""), F.lit(tail)).alias("text")
    )
