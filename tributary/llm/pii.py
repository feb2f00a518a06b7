"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust their scores.

Kinds, in order: ``email``, ``ip``, ``card``, ``phone`` (the base), ``iban``, ``local_phone``, ``secret`` (added). Matches
are leftmost and do not overlap within a kind; those that fail a check are dropped without another try, but for
``iban``: words at its end are left off until the check passes, and it is looked for at every possible beginning.
Context words within ``NEARBY`` code points before or after a match raise its score by the kind's ``lift``, words that
speak of something else (orders, invoices, serial numbers) lower it as much. Base spans that pass stay whatever their
score; an added span needs a score of ``MIN_SCORE``: account numbers need no word for them, but words against
them refuse them, and secrets and telephone numbers without a country code need one. At just ``MIN_SCORE`` a span stays.

The patterns are written for linear time and constant stack: a run of characters is entered at its start or
where the last match ended, and repeated groups are possessive. Each finds what its plain form finds.

Nulls: a null text counts as empty and has no spans. Repeated rows are treated alike; an empty table gives an
empty table; other columns pass, and one named ``pii`` is replaced. Texts of any length are searched whole, each in
one task. Spans of unlike kinds may overlap; ``mask`` replaces each group of overlapping ones by the kind of the one
that begins first, of these the longest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
MIN_SCORE = 0.5
#: Code points before and after a match that are searched for context words.
NEARBY = 40
#: Words that say that a number stands for something else.
OTHERS = r"(?iu)(?<!\p{L})(?:order|invoice|serial|sku|isbn|bestell\p{L}*|rechnung\p{L}*|commande|facture|pedido|factura)(?!\p{L})"

SPAN = "struct<kind:string,start:int,end:int,score:double>"

OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def luhn(number: Column) -> Column:
    """Luhn's check over a string of digits: every second digit from the right counts double, less 9 above 9."""
    n = F.length(number)

    def weighed(i: Column) -> Column:
        d = number.substr(n - i, F.lit(1)).cast("int")
        twice = d * F.lit(2)
        return F.when(i % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + weighed(i)) % 10 == 0


def mod97(account: Column) -> Column:
    """The check of international account numbers: the first four characters go last, letters count 10 to 35."""
    bare = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.concat(bare.substr(F.lit(5), F.length(bare)), F.substring(bare, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        code = F.ascii(turned.substr(i, F.lit(1)))
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


@dataclass(frozen=True)
class Kind:
    """``guard``: what a text must contain to be searched. ``context``: words nearby that raise the score by ``lift``; OTHERS lower it
    as much. ``sure``: how a match begins that needs no context."""

    name: str
    pattern: str
    guard: str
    context: str
    score: float
    lift: float
    sure: str = r"(?!)"

    def valid(self, match: Column) -> Column:
        number = digits(match)
        if self.name == "ip":
            return match.rlike(rf"\A{OCTET}(?:\.{OCTET}){{3}}\z")
        if self.name == "card":
            return F.length(number).between(16, 19) & luhn(number)
        if self.name == "phone":
            return F.length(number).between(8, 15)
        if self.name == "iban":
            return F.length(F.replace(match, F.lit(" "), F.lit(""))).between(15, 34) & mod97(match)
        if self.name == "local_phone":
            return F.length(number).between(7, 11)
        if self.name == "secret":
            run = match.rlike(r"\A[A-Za-z0-9+/_-]{16,}=*\z")
            return match.rlike(rf"\A{self.sure}") | ~run | ((F.length(match) >= 20) & (F.length(number) >= 3) & match.rlike("[A-Za-z]"))
        return F.lit(True)

    def accepted(self, match: Column) -> Column:
        """What of the match passes, or null; a following word in capitals may look like the end of an account number."""
        if self.name != "iban":
            return F.when(self.valid(match), match)
        words = F.split(match, " ")
        shorter = F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))
        return F.get(F.filter(shorter, self.valid), F.lit(0))


#: Words that make a number without a country code a telephone number.
CALLS = r"(?iu)(?<!\p{L})(?:tel|t[eé]l[eé](?:ph|f)\p{L}*|phone[sd]?|call(?:s|ed|ing)?|fax\p{L}*|mobil\p{L}*|anruf\p{L}*|ll[aá]m\p{L}*)(?!\p{L})"

#: Words that make a long run of letters and digits a key that lets someone in.
SECRETS = r"(?iu)token|secret|api[_ -]?key|access[_ -]?key|passw|pwd|credential|bearer|authorization|private[_ -]?key|schlüssel|clé d|contraseña"
# How the keys of widespread services begin.
PREFIXED = r"(?:AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|sk-|sk_live_|xox[abprs]-|AIza|eyJ)[A-Za-z0-9_-]{12,}"

# The base kinds' patterns, in their linear forms.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@", r"mail|contact|write|schreib|correo|courriel", 0.9, 0.1),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", r"\bip\b|host|server|address|adresse", 0.6, 0.3),
    Kind("card", r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){15,}+", r"[0-9]", r"card|visa|credit|karte|carte|tarjeta", 0.8, 0.2),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", r"tel|phone|call|fax|mobil|anruf|llam", 0.7, 0.2),
    Kind("iban", r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]{4}){2,7}(?:[\x20]?[A-Z0-9]{1,3})?)(?![A-Za-z0-9]))[A-Z]{2}[0-9]{2}", r"[A-Z]{2}[0-9]{2}", r"iban|account|konto|compte|cuenta", 0.6, 0.2),
    Kind("local_phone", r"(?<![0-9A-Za-z+.-])[(]?[0-9][0-9().\x20-]{5,16}[0-9](?![0-9A-Za-z])", CALLS, CALLS, 0.2, 0.4),
    Kind("secret", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}+=*+|(?<=(?:password|passwd|pwd|passwort)[\x22\x27]?[\x20]{0,2}[:=][\x20]{0,2}[\x22\x27]?)(?=[^\s\x22\x27,;]*[0-9])[^\s\x22\x27,;]{6,64}", rf"{PREFIXED}|{SECRETS}", SECRETS, 0.2, 0.4, PREFIXED),
)


def spans_of(kind: Kind, text: Column) -> Column:
    """The kind's spans as an array of SPAN, in order; places are code points, ends exclusive.

    A text is cut at the matches; the lengths of what lies between and of the matches add up to the places. Where
    a pattern has a group, that is what is checked, and may go beyond the match.
    """
    group = F.lit(int(kind.name == "iban"))
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    accepted = F.transform(F.regexp_extract_all(text, F.lit(kind.pattern), group), kind.accepted)
    found = F.struct(matches.alias("m"), accepted.alias("accepted"), F.split(text, kind.pattern, -1).alias("between"))
    nothing = F.array().cast(f"array<{SPAN}>")

    def walk(x: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("free"), F.lit("").alias("last"), nothing.alias("out"))

        def step(state: Column, i: Column) -> Column:
            match, whole, before = F.get(x["m"], i), F.get(x["accepted"], i), F.get(x["between"], i)
            begin = state["at"] + F.length(before)
            end = begin + F.length(whole)
            last = F.right(F.concat(state["last"], before), F.lit(NEARBY))
            after = F.concat_ws("", F.left(F.get(x["between"], i + 1), F.lit(2 * NEARBY)), F.get(x["m"], i + 1), F.left(F.get(x["between"], i + 2), F.lit(NEARBY)))
            near = F.concat(last, F.lit("\n"), after.substr(F.length(whole) - F.length(match) + 1, F.lit(NEARBY)))
            score = F.lit(kind.score) + F.when(F.lower(near).rlike(kind.context), F.lit(kind.lift)).otherwise(F.lit(0.0))
            if kind.name == "secret":
                score = F.when(whole.rlike(rf"\A{kind.sure}"), F.lit(kind.score + kind.lift)).otherwise(score)
            else:
                score = score - F.when(near.rlike(OTHERS), F.lit(kind.lift)).otherwise(F.lit(0.0))
            take = whole.isNotNull() & (begin >= state["free"]) & (F.lit(kind.name in BASE_KINDS) | (score >= MIN_SCORE))
            span = F.struct(F.lit(kind.name).alias("kind"), begin.alias("start"), end.alias("end"), score.alias("score")).cast(SPAN)
            return F.struct(
                (begin + F.length(match)).alias("at"),
                F.when(take, end).otherwise(state["free"]).alias("free"),
                F.right(F.concat(last, match), F.lit(NEARBY)).alias("last"),
                F.when(take, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"),
            )

        return F.aggregate(F.sequence(F.lit(0), F.size(x["m"]) - 1), start, step, lambda s: s["out"])

    return F.when(text.rlike(kind.guard) & text.rlike(kind.pattern), F.get(F.transform(F.array(found), walk), F.lit(0))).otherwise(nothing)


def find(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``pii``, an array of ``struct<kind, start, end, score>`` by kind as listed, then by start."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return df.withColumn("pii", F.concat(*[spans_of(kind, whole) for kind in KINDS]))


def mask(text: Column, spans: Column) -> Column:
    """The text with each span, or each group of overlapping ones, replaced by its kind in brackets."""
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, s: Column) -> Column:
        at, end = state["at"], -s["end"]
        apart = s["start"] >= at
        more = F.array(text.substr(at + 1, s["start"] - at), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(F.greatest(at, end).alias("at"), F.when(apart, F.concat(state["out"], more)).otherwise(state["out"]).alias("out"))

    cut = F.aggregate(ranked, begin, step, lambda x: F.concat(F.array_join(x["out"], ""), text.substr(x["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, cut).otherwise(text)
