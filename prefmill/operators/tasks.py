"""Tasks from raw question-reference rows, pilots, and training configurations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefmill.operators import contracts
from prefmill.operators.shaping import message
from prefmill.operators.subsets import sample_balanced
from prefmill.sources.jsonl import InputError


def from_questions(raw: DataFrame) -> DataFrame:
    """Second-turn tasks: the first question, its reference and the second question; the second reference is the chosen answer."""
    q, r = F.col("questions"), F.col("references")
    prompt = F.array(message("user", q[0]), message("assistant", r[0]), message("user", q[1]))
    return raw.select("id", "category", prompt.alias("prompt"), r[1].alias("chosen"))


def normalized(rows: DataFrame) -> DataFrame:
    """Tasks from prepared or raw rows; which of both a row is, its columns tell."""
    if "prompt" not in rows.columns:
        return from_questions(rows)
    made = rows.select("id", "category", "prompt", "chosen")
    if "questions" not in rows.columns:
        return made
    return made.where("prompt is not null").unionByName(from_questions(rows.where("prompt is null")))


def check_judging(batch_size: int, max_model_len: int, max_tokens: int, temperature: float = 0.0, group_size: int = 1) -> None:
    """Ranges of the settings of a judging or generating run."""
    faults = [k for k, v in (("batch_size", batch_size), ("max_model_len", max_model_len), ("max_tokens", max_tokens)) if v < 1]
    if max_tokens >= max_model_len:
        faults.append("max_tokens must be below max_model_len")
    if temperature < 0:
        faults.append("temperature")
    if group_size not in (1, 2):
        faults.append("group_size must be 1 or 2")
    if faults:
        raise InputError(f"unsound settings: {faults}")


def checked(tasks: DataFrame, categories: list[str]) -> DataFrame:
    """The tasks, or an error that lists the first breaches; no tasks are a breach too."""
    if not tasks.limit(1).count():
        raise InputError("there are no tasks")
    contracts.require_empty(contracts.violations(tasks, contracts.task_rules(categories)), "tasks break their contract")
    contracts.require_empty(contracts.duplicate_keys(tasks, "id"), "task ids repeat")
    return tasks


def pilot(tasks: DataFrame, per_category: int, seed: int = 42) -> DataFrame:
    return sample_balanced(tasks, per_category, seed, "pilot")


def merged_config(base: dict, stage: dict, own: tuple[str, ...] = ("name", "data")) -> dict:
    """A stage's settings over the common ones, without the stage's own keys."""
    return {**base, **{k: v for k, v in stage.items() if k not in own}}


def check_training(config: dict) -> None:
    """Positive sizes, a ratio between 0 and 1, a budget that holds both parts, savings that fall on evaluations."""
    faults = [k for k in ("max_prompt_length", "max_completion_length", "max_length") if not (isinstance(config.get(k), int) and config[k] > 0)]
    if not 0 < config.get("train_ratio", 0) < 1:
        faults.append("train_ratio")
    if not faults and config["max_prompt_length"] + config["max_completion_length"] > config["max_length"]:
        faults.append("max_length")
    if config.get("save_steps", 0) % max(1, config.get("eval_steps", 1)):
        faults.append("save_steps")
    if config.get("loss_type", "sigmoid") != "sigmoid":
        faults.append("loss_type")
    names = [s.get("name") for s in config.get("stages", [])]
    if len(set(names)) != len(names):
        faults.append("stages")
    if faults:
        raise InputError(f"unsound settings: {faults}")
