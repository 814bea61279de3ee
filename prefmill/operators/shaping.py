"""Training shapes: SFT rows, conversational pairs, chat templates, token budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def sft_rows(raw: DataFrame, source_model: str = "", source_path: str = "") -> DataFrame:
    """Two rows a question-reference pair: the first turn, and both turns."""
    q, r = F.col("questions"), F.col("references")
    one = [message("user", q[0]), message("assistant", r[0])]
    both = [*one, message("user", q[1]), message("assistant", r[1])]

    def meta(turn: int) -> Column:
        return F.struct(F.col("id").alias("question_id"), "category", F.lit(source_model).alias("source_model"), F.lit(source_path).alias("source_path"), F.lit(turn).alias("turn"))

    made = F.array(F.struct(F.array(*one).alias("messages"), meta(1).alias("meta")), F.struct(F.array(*both).alias("messages"), meta(2).alias("meta")))
    return raw.select(F.inline(made))


def conversational(pairs: DataFrame) -> DataFrame:
    """Preference pairs with completions as assistant messages."""
    return pairs.select("prompt", F.array(message("assistant", F.col("chosen"))).alias("chosen"), F.array(message("assistant", F.col("rejected"))).alias("rejected"))


def chat_text(messages: str, before: dict[str, str], after: str, begin: str = "", end: str = "") -> Column:
    """Messages rendered one after another: a marker by role, the content, a marker."""

    def one(m: Column) -> Column:
        mark = F.lit("")
        for role, text in before.items():
            mark = F.when(m["role"] == role, F.lit(text)).otherwise(mark)
        return F.concat(mark, m["content"], F.lit(after))

    return F.concat(F.lit(begin), F.array_join(F.transform(F.col(messages), one), ""), F.lit(end))


def truncated_ids(df: DataFrame, prompt: str, completion: str, eos: int, max_prompt: int, max_completion: int) -> DataFrame:
    """The prompt keeps its last ids, the completion its first with the end id appended if absent."""
    p = F.slice(F.col(prompt), F.greatest(F.size(prompt) - max_prompt + 1, F.lit(1)), max_prompt)
    full = F.when(F.coalesce(F.try_element_at(F.col(completion), F.lit(-1)) == eos, F.lit(False)), F.col(completion)).otherwise(F.array_append(F.col(completion), F.lit(eos)))
    return df.withColumns(
        {
            "prompt_ids": p,
            "completion_ids": F.slice(full, 1, max_completion),
            "prompt_truncated": F.size(prompt) > max_prompt,
            "completion_truncated": F.size(full) > max_completion,
        }
    )


def encoded(df: DataFrame, texts: dict[str, str], tokenizer: str) -> DataFrame:
    """Add ids (new column -> text column) of a tokenizer file in the tokenizers library's format; no special tokens.

    The file is a path that every worker can open. Arrow batches, one narrow pass.
    """
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.ArrayType(T.IntegerType())) for n in texts)])

    def run(batches):
        import pyarrow as pa
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer)
        t.no_truncation()
        t.no_padding()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                made = [pa.array([e.ids for e in t.encode_batch([x or "" for x in part.column(c).to_pylist()], add_special_tokens=False)], pa.list_(pa.int32())) for c in texts.values()]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *texts])

    return df.mapInArrow(run, schema)


def rendered_ids(df: DataFrame, prompt: str, full: str, eos: int | None, max_prompt: int, max_completion: int, max_length: int) -> DataFrame:
    """The completion's ids are what the whole dialogue's ids have behind the prompt's.

    One id at the boundary may have merged with the completion's first. The end
    id is appended if absent; the prompt keeps its last ids, the completion its
    first. error says what is unsound, null if nothing is.
    """
    n = F.size(prompt)
    same = F.slice(full, 1, n) == F.col(prompt)
    merged = (n >= 1) & (F.slice(full, 1, F.greatest(n - 1, F.lit(0))) == F.slice(prompt, 1, F.greatest(n - 1, F.lit(0))))
    kept = F.when(same, n).when(merged, n - 1)
    out = df.withColumns({"_p": F.slice(full, 1, kept), "_c": F.slice(full, kept + 1, F.greatest(F.size(full) - kept, F.lit(0)))})
    append = F.lit(False) if eos is None else ~F.coalesce(F.try_element_at(F.col("_c"), F.lit(-1)) == eos, F.lit(False))
    out = out.withColumn("eos_appended", append).withColumn("_c", F.when(append, F.array_append("_c", F.lit(eos))).otherwise(F.col("_c")))
    out = out.withColumns({"prompt_ids": F.slice("_p", F.greatest(F.size("_p") - max_prompt + 1, F.lit(1)), max_prompt), "completion_ids": F.slice("_c", 1, max_completion)})
    p, c = F.size("prompt_ids"), F.size("completion_ids")
    error = F.when(kept.isNull(), "prompt is no prefix").when(p + c > max_length, "over max_length").when((p < 1) | (c < 1), "empty part")
    return out.withColumns({"prompt_tokens": p, "completion_tokens": c, "prompt_truncated": F.size("_p") > max_prompt, "completion_truncated": F.size("_c") > max_completion, "error": error}).drop("_p", "_c")


def completion_after(full: Column, prompt: Column) -> Column:
    """The rendered dialogue behind the rendered prompt; null if that is no prefix."""
    return F.when(F.startswith(full, prompt), F.substr(full, F.length(prompt) + 1))


def token_count(ids: str, end: bool = False) -> Column:
    """Ids of a text, and one more for the end id if asked, whether or not it is there."""
    return F.size(ids) + int(end)


def truncation_counts(df: DataFrame, max_prompt: int, max_completion: int, max_length: int, by: list[str] | None = None) -> DataFrame:
    """Rows whose prompt, chosen or rejected part is cut, and whose parts together are still too long then."""
    longest = F.greatest(F.least(F.col("chosen_tokens"), F.lit(max_completion)), F.least(F.col("rejected_tokens"), F.lit(max_completion)))
    return df.groupBy(*(by or [])).agg(
        F.count_if(F.col("prompt_tokens") > max_prompt).alias("prompt_cut"),
        F.count_if(F.col("chosen_tokens") > max_completion).alias("chosen_cut"),
        F.count_if(F.col("rejected_tokens") > max_completion).alias("rejected_cut"),
        F.count_if(F.least(F.col("prompt_tokens"), F.lit(max_prompt)) + longest > max_length).alias("combined_over"),
    )


def token_stats(df: DataFrame, columns: list[str], by: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """min, mean (2 decimals), p50, p95, max of token counts; rows over a limit in total."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"{c}_min"), F.round(F.avg(c), 2).alias(f"{c}_mean")]
        aggs += [F.expr(f"percentile_disc({f}) WITHIN GROUP (ORDER BY {c})").alias(f"{c}_p{round(100 * f)}") for f in (0.5, 0.95)]
        aggs.append(F.max(c).alias(f"{c}_max"))
    if limit is not None:
        total = sum((F.col(c) for c in columns), F.lit(0))
        aggs.append(F.count_if(total > limit).alias("over_limit"))
    return df.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"), *aggs)


def training_steps(rows: int, batch: int, accumulation: int, epochs: float, warmup_ratio: float, least_warmup: int = 1) -> tuple[int, int]:
    """(optimizer steps, warm-up steps) of a run."""
    per_epoch = -(-rows // (batch * accumulation))
    steps = max(1, int(per_epoch * epochs))
    return steps, max(least_warmup, int(steps * warmup_ratio))


def model_inputs(df: DataFrame, ids: str, max_length: int) -> DataFrame:
    """input_ids cut to a length, and an attention mask of ones as long."""
    cut = F.slice(ids, 1, max_length)
    return df.withColumns({"input_ids": cut, "attention_mask": F.transform(cut, lambda x: F.lit(1))})
