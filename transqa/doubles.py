"""Test double of a model service.

``DoubleClient`` answers by fixed arithmetic on the prompt's text, so that
the same answers can be written in SQL. It translates nothing and judges nothing:
it shows that the right prompt reaches a client and that answers are handled right.
"""

from __future__ import annotations

from transqa.functions.text import FENCE

DETECTED = (
    ((" the ", " and "), "en"),
    ((" der ", " und "), " de\n"),
    ((" que ", " los "), "es"),
    ((" le ", " et "), "fr\n"),
)


class DoubleClient:
    """Deterministic answers to every kind of prompt the workflow sends."""

    def complete(self, endpoint: str, prompt: str) -> str:
        if prompt.startswith("Identify the primary language"):
            return self._detect(prompt.split("return en. Text: ", 1)[1])
        if prompt.startswith("You are a translation quality judge"):
            return self._judge(prompt)
        if prompt.startswith("Decide whether a translation"):
            return self._rule(prompt)
        text = prompt.split("Text:\n", 1)[1]
        if "following English text to " in prompt[:120]:
            lang = prompt.split("English text to ", 1)[1].split(". Maintain", 1)[0]
            return f"[{lang}] {text}"
        if len(text) % 97 == 0:
            raise RuntimeError("overloaded")
        return text[: len(text) * ((len(text) + len(endpoint)) % 10) // 10]

    @staticmethod
    def _detect(text: str) -> str:
        for needles, answer in DETECTED:
            if any(n in text for n in needles):
                return answer
        return "xx"

    @staticmethod
    def _judge(prompt: str) -> str:
        original = prompt.split("\nORIGINAL (", 1)[1].split("):\n", 1)[1]
        chars = len(original.split("\n\nBACK-TRANSLATION (", 1)[0])
        verdict = f'{{"passed": {"false" if chars % 3 == 0 else "true"}, "rationale": "read {chars}"}}'
        return in_form(verdict, chars % 5)

    @staticmethod
    def _rule(prompt: str) -> str:
        rule, rest = prompt.split("RULE:\n", 1)[1].split("\n\nORIGINAL:\n", 1)
        original = rest.split("\n\nTRANSLATION:\n", 1)[0]
        kept = (len(rule) + len(original)) % 11 != 0
        return f'{{"passed": {str(kept).lower()}, "rationale": "rule of {len(rule)}"}}'


def in_form(verdict: str, form: int) -> str:
    """The shapes a judge's reply comes in: plain, fenced, fenced on one line, broken."""
    if form == 1:
        return f"{FENCE}json\n{verdict}\n{FENCE}\n"
    if form == 2:
        return f"{FENCE}json {verdict} {FENCE}"
    if form == 3:
        return verdict[:-4]
    return f" {verdict}\n"
