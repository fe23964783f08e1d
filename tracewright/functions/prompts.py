"""Chat messages and training pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALES = {"4way": ("none", "low", "medium", "high"), "5way": ("none", "low", "medium", "high", "critical")}
PREFIX = '{"severity":"'
#: A system prompt of our own; <SEVERITIES> takes the scale. Callers pass theirs where a model was trained on another.
SYSTEM = """You classify one security event. Answer with JSON only:
{"severity": <SEVERITIES>, "isThreat": boolean, "threatType": string or null, "indicators": {"key": "value"}, "reasoning": "one to three sentences"}"""


def system_prompt(scale: str = "4way", template: str = SYSTEM) -> str:
    return template.replace("<SEVERITIES>", " or ".join(f'"{s}"' for s in SCALES[scale]))


def user_text(event: Column) -> Column:
    return F.concat(F.lit("Event:\n"), event, F.lit("\n\nClassify."))


def messages(event: Column, scale: str = "4way", template: str = SYSTEM) -> Column:
    """array<struct<role, content>>: the system prompt and the event."""
    one = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(one("system", F.lit(system_prompt(scale, template))), one("user", user_text(event)))


def model_file(base: str, adapter: str, weights: str, context: int, scale: str = "4way", template: str = SYSTEM, parameters: dict[str, str] | None = None) -> str:
    """The configuration text of a serving runtime for a tuned model: weights, system prompt and sampling parameters."""
    head = [f"# Made from the prompt of scale {scale} ({len(SCALES[scale])} severities, severity first); make it anew after a change.", f"# adapter: {adapter}", f"# base: {base}", ""]
    body = [f"FROM {weights}", "", 'SYSTEM """', system_prompt(scale, template), '"""', ""]
    values = {"temperature": "0.1", "top_p": "0.9", "repeat_penalty": "1.1", "num_ctx": str(context), "stop": '"<|im_end|>"'} | (parameters or {})
    return "\n".join([*head, *body, *(f"PARAMETER {k} {v}" for k, v in values.items())]) + "\n"


def prompt_hash(scale: str = "4way", template: str = SYSTEM) -> Column:
    return F.sha2(F.lit(system_prompt(scale, template)), 256)


#: Fixed value: how the event of a row begins that stands for an event still to be pasted in.
PLACEHOLDER = "PASTE_"


def filled_in(rows: DataFrame) -> DataFrame:
    """rows whose event is there, not a placeholder for one: only these can be scored."""
    return rows.where(~F.col("event").startswith(PLACEHOLDER))


def training_pairs(rows: DataFrame, validation: DataFrame, scale: str = "4way") -> DataFrame:
    """rows (with targets) as prompt and completion, split by signature; rows outside the scale are left out."""
    marked = rows.where(F.col("severity").isin(*SCALES[scale])).join(validation.select("signature", F.lit(True).alias("_v")), "signature", "left")
    return marked.select(messages(F.col("event"), scale).alias("prompt"), F.col("target").alias("completion"), "id", "gold", "severity", "signature", F.when(F.col("_v"), "val").otherwise("train").alias("split"))
