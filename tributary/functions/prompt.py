"""Few-shot prompts: all that is constant is rendered once on the driver, the feedback is concatenated in."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.sources.taxonomy import Taxonomy, as_json


@dataclass(frozen=True)
class Example:
    """One solved case: the input and the reply that is wanted for it, as JSON text."""

    input: str
    output_json: str


def case(text: str, fields: tuple[str, str, str, str]) -> Example:
    """An example whose record has the four fields, a line each."""
    names = ("prediction_class", "attribution", "priority", "reason")
    return Example(text, "{\n" + ",\n".join(f'  "{k}": "{v}"' for k, v in zip(names, fields, strict=True)) + "\n}")


CASES = (
    case("I was billed two times for one order.", ("Payments", "charged twice", "High", "Money was taken that is not owed.")),
    case("The list takes half a minute to come up.", ("Network", "slow loading", "Medium", "It works, but the wait is long.")),
    case("My new photo is shown on one page and the old one on the next.", ("Accounts", "profile: picture, name", "Medium", "A change does not reach all pages.")),
)


@dataclass(frozen=True)
class Template:
    """The wording around taxonomy and feedback, headings included. All of it is the caller's to replace."""

    opening: str = "You sort user feedback for a support team. For each message, find what went wrong and answer with one JSON object and nothing else."
    answer_heading: str = "## The object's fields"
    answer: Sequence[str] = (
        "prediction_class - a class of the table below, spelled as there",
        "attribution - a cause listed for that class; where none fits, a few words of your own",
        "priority - High: the user cannot go on; Medium: something works badly; Low: a wish, or looks only",
        "reason - one sentence",
    )
    advice_heading: str = "## When in doubt"
    advice: Sequence[str] = ("Take the message as a whole before any single word.",)
    taxonomy_heading: str = "## Classes and their causes"
    cases_heading: str = "## Solved cases"
    cases: Sequence[Example] = CASES
    message: str = "Message"
    reply: str = "Object"

    def prefix(self, taxonomy: Taxonomy) -> str:
        """Everything up to the opening quote of the feedback; starts with a line break."""
        parts = [
            f"\n{self.opening}\n",
            f"{self.answer_heading}\n" + "".join(f"* {x}\n" for x in self.answer),
            f"{self.advice_heading}\n" + "".join(f"* {x}\n" for x in self.advice),
            f"{self.taxonomy_heading}\n{as_json(taxonomy)}\n",
            f"{self.cases_heading}\n" + "\n".join(f'{self.message}: "{x.input}"\n{self.reply}:\n{x.output_json}\n' for x in self.cases),
            f'{self.message}: "',
        ]
        return "\n".join(parts)

    @property
    def suffix(self) -> str:
        """The closing quote and the cue for the answer."""
        return f'"\n{self.reply}:\n'

    def render(self, taxonomy: Taxonomy, feedback: str | None) -> str:
        """The prompt for one feedback, on the driver."""
        return f"{self.prefix(taxonomy)}{feedback}{self.suffix}"


def prompt_column(template: Template, taxonomy: Taxonomy, feedback: Column) -> Column:
    """The prompt as an expression; the feedback goes in unescaped, and a null one as ``None``.

    ``concat`` and not a replacement or a format: ``$``, ``\\`` and ``%`` in feedback mean themselves.
    """
    return F.concat(F.lit(template.prefix(taxonomy)), F.coalesce(feedback, F.lit("None")), F.lit(template.suffix))
