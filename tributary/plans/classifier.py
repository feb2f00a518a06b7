"""The engine: feedback in, one typed row per feedback out."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.prompt import Template, prompt_column
from tributary.functions.response import clean_text
from tributary.operators.infer import ClientFactory, infer
from tributary.operators.joins import lookup
from tributary.operators.parse import ERROR_PREFIX, FALLBACK, results
from tributary.sources.taxonomy import Taxonomy, validated


class Classifier:
    """Renders prompts around a taxonomy, calls the client once per row, cleans and parses the replies.

    ``factory`` makes the client, on each partition. ``config`` is kept for the caller and not read.
    """

    def __init__(self, factory: ClientFactory, config: Any = None, *, taxonomy: Taxonomy, template: Template | None = None, mode: str = "compat"):
        self.factory = factory
        self.config = config
        self.taxonomy = validated(taxonomy)
        self.template = template or Template()
        self.mode = mode

    def prompts(self, feedback: DataFrame) -> DataFrame:
        """``(feedback_id, prompt)``. The prompt is several kilobytes of constant text: build it last, store it never."""
        return feedback.select("feedback_id", prompt_column(self.template, self.taxonomy, F.col("feedback")).alias("prompt"))

    def respond(self, feedback: DataFrame, *, dedup: bool = False, **options: Any) -> DataFrame:
        """The raw replies; see ``infer`` for the options.

        ``dedup`` (an extension) calls once per distinct feedback and joins the replies back, for inputs with many
        equal texts and a client that answers alike; the feedback is shuffled, the prompts are not, and a text that
        fills the table is dealt over many tasks.
        """
        if not dedup:
            return infer(self.prompts(feedback), self.factory, **options)
        texts = feedback.select("feedback").distinct()
        once = texts.select("feedback", prompt_column(self.template, self.taxonomy, F.col("feedback")).alias("prompt"))
        replies = infer(once, self.factory, key="feedback", **options)
        joined = lookup(feedback.select("feedback_id", "feedback"), replies, ["feedback"])
        return joined.select("feedback_id", "response", "error_class", "error_text")

    def classify(self, feedback: DataFrame, **options: Any) -> DataFrame:
        """One row per row of ``(feedback_id, feedback)``: status, error, JSON text and the four fields."""
        return results(self.respond(feedback, **options), mode=self.mode)

    def classify_one(self, feedback: str | None) -> Any:
        """One feedback on the driver: the parsed JSON value, or the fixed record with the error's text."""
        prompt = self.template.render(self.taxonomy, feedback)
        try:
            return json.loads(clean_text(self.factory().chat(prompt), self.mode))
        except Exception as error:
            return FALLBACK | {"reason": f"{ERROR_PREFIX}{error}"}
