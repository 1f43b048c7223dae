"""Context packing and answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from thicket.functions import bpe
from thicket.functions.text import words

BUDGET, SEPARATOR = 3500, "\n\n"


def count_words(c: Column) -> Column:
    """The default token counter; any column function can take its place."""
    return F.size(words(c))


def bpe_counter(ranks_path: str) -> Callable[[Column], Column]:
    """A token counter of columns over a byte-pair rank file; functions.bpe.token_counts() is the one for whole tables."""

    @F.pandas_udf("int")
    def count(cut: pd.Series) -> pd.Series:
        known, sizes = bpe.ranks(ranks_path), {}

        def size(piece: str) -> int:
            if piece not in sizes:
                sizes[piece] = len(bpe.merged(piece.encode(), known))
            return sizes[piece]

        return cut.map(lambda found: sum(map(size, found)))

    return lambda c: count(bpe.pieces(c))


def pack(hits: DataFrame, budget: int = BUDGET, counter: Callable[[Column], Column] = count_words, text: str = "content") -> DataFrame:
    """The prefix of each query's hits whose token counts add up to the budget at most, with the running sum."""
    counted = hits.withColumn("n_tokens", counter(F.coalesce(text, F.lit(""))))
    running = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumn("running_tokens", F.sum("n_tokens").over(running)).filter(F.col("running_tokens") <= budget)


def contexts(packed: DataFrame, text: str = "content") -> DataFrame:
    """(query_id, context, doc_ids, context_length) with texts in rank order; context_length counts characters."""
    listed = packed.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "doc_id", F.coalesce(text, F.lit("")).alias("t")))).alias("_all"))
    joined = F.array_join(F.transform("_all", lambda x: x["t"]), SEPARATOR)
    return listed.select("query_id", joined.alias("context"), F.transform("_all", lambda x: x["doc_id"]).alias("doc_ids"), F.length(joined).alias("context_length"))


def echo_reader(question: str, context: str) -> str:
    """A deterministic stand-in for a language model: the first sentence of the context."""
    return context.split(". ")[0][:200] if context else ""


def answers(questions: DataFrame, context: DataFrame, reader: Callable[[str, str], str] = echo_reader) -> DataFrame:
    """questions(query_id, question) with context, answer and error; a failing question gives its error and goes on."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made, wrong = [], []
            for q, c in zip(f["question"], f["context"]):
                try:
                    made.append(reader(q or "", c or ""))
                    wrong.append(None)
                except Exception as e:  # the reader is foreign code; its failure is data here
                    made.append(None)
                    wrong.append(f"{type(e).__name__}: {e}")
            yield f.assign(generated_answer=made, error=wrong)

    joined = questions.select("query_id", "question").join(context, "query_id", "left")
    schema = StructType([*joined.schema.fields, StructField("generated_answer", StringType()), StructField("error", StringType())])
    return joined.mapInPandas(run, schema)


# What a record's block says of antibiotics and of what it lacks.
NO_ANTIBIOTIC, ODD_ANTIBIOTIC, NO_DETAIL = "Este medicamento no contiene antibióticos.", "Formato desconocido para el campo 'antibiotico'", "No especificado"
UNNAMED, NO_INDICATION = "No especificada", "  - No especificadas"


def record_blocks(records: DataFrame) -> DataFrame:
    """(nregistro, block): a labelled block of each reshaped record (see documents.reshape_for_model) for a model's context."""
    said = F.filter("especies", lambda s: F.size(F.coalesce(F.try_element_at("indicaciones", s), F.array().cast("array<string>"))) > 0)
    by_species = F.array_join(F.transform(said, lambda s: F.concat(F.lit("  - "), s, F.lit(": "), F.array_join(F.try_element_at("indicaciones", s), ", "))), "\n")
    detail = lambda a: F.concat(F.lit("  - Principio activo: "), F.coalesce(a["principio"], F.lit(UNNAMED)), F.lit("\n    Familia: "), F.coalesce(a["familia"], F.lit(UNNAMED)), F.lit("\n    Categoría: "), F.coalesce(a["categoria"], F.lit(UNNAMED)))
    listed = F.from_json(F.when(F.lower(F.trim("antibiotico")) != "no", F.col("antibiotico")), "array<struct<categoria:string,familia:string,principio:string>>")
    drug = F.when(F.lower(F.trim("antibiotico")) == "no", NO_ANTIBIOTIC).when(listed.isNull(), ODD_ANTIBIOTIC).when(F.size(listed) == 0, NO_DETAIL).otherwise(F.concat(F.lit("Antibióticos:\n"), F.array_join(F.transform(listed, detail), "\n")))
    block = F.concat(F.lit("Nombre: "), F.coalesce("nombre", F.lit("")), F.lit("\nEspecies: "), F.array_join("especies", ", "), F.lit("\nIndicaciones por especie:\n"), F.coalesce(F.nullif(by_species, F.lit("")), F.lit(NO_INDICATION)), F.lit("\nAntibiótico: "), drug, F.lit("\nVías: "), F.array_join("ruta_administracion", ", "))
    return records.select("nregistro", block.alias("block"))


def group_contexts(blocks: DataFrame, groups: DataFrame, n: int = 10, seed: int = 0) -> DataFrame:
    """(value, n_blocks, context): of each group(value, id) at most n blocks, chosen by a seeded hash, in id order."""
    chosen = Window.partitionBy("value").orderBy(F.sha2(F.concat("id", F.lit(f":{seed}")), 256), "id")
    some = groups.withColumn("_nth", F.row_number().over(chosen)).filter(F.col("_nth") <= n).join(blocks.withColumnRenamed("nregistro", "id"), "id")
    listed = some.groupBy("value").agg(F.array_sort(F.collect_list(F.struct("id", "block"))).alias("_all"))
    return listed.select("value", F.size("_all").alias("n_blocks"), F.array_join(F.transform("_all", lambda x: x["block"]), SEPARATOR).alias("context"))


#: What precedes and follows a group's context in a prompt; {group} is its value.
PROMPT = ("Fichas del grupo '{group}':\n\n", "\n\nPropón una sola pregunta en español cuya respuesta esté en estas fichas.")


def group_questions(groups: DataFrame, reader: Callable[[str, str], str] = echo_reader, prompt: tuple[str, str] = PROMPT) -> DataFrame:
    """(value, prompt, question, error) of groups(value, context): the reader is asked once a group; a failure gives its error."""
    head = F.replace(F.lit(prompt[0]), F.lit("{group}"), F.col("value"))
    asked = groups.select(F.col("value").alias("query_id"), F.concat(head, F.col("context"), F.lit(prompt[1])).alias("question"))
    done = answers(asked, groups.select(F.col("value").alias("query_id"), "context"), reader)
    return done.select(F.col("query_id").alias("value"), F.col("question").alias("prompt"), F.col("generated_answer").alias("question"), "error")
