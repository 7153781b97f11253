"""Stand-ins for a language model, for tests and for the query catalogue.

They answer by fixed rules over the prompt.  They exercise the plumbing and say
nothing about the quality of real answers.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from talkatlas.functions.text import WHITESPACE
from talkatlas.operators.facets import FACET_SPECS

REQUEST_START = "The user's overall request for the assistant is to answer: "
# A language is told by the first of these words found among the turns.
LANGUAGE_MARKS = ((" und ", "German"), (" qui ", "French"), (" los ", "Spanish"))
OTHER_LANGUAGE = "English"


def stub_facets(prompt: str) -> dict[str, str]:
    """Facet values by rule from the conversation inside a prompt."""
    turns = re.findall(r'  <turn role="([^"]*)">(.*?)</turn>', prompt, re.S)
    asked = [content for role, content in turns if role == "user"]
    everything = " ".join(content for _, content in turns).lower()
    found = [name for mark, name in LANGUAGE_MARKS if mark in everything]
    return {
        "request": REQUEST_START + asked[0].strip(WHITESPACE) if asked else "",
        "language": found[0] if found else OTHER_LANGUAGE,
        "task": f"The task is to reply to {len(asked)} user turns.",
        "concerning": str(1 + len(turns) % 5),
    }


def stub_facet_completer() -> Callable[[str], str]:
    """Answers batched and single-facet prompts."""

    def answer(prompt: str) -> str:
        values = stub_facets(prompt)
        asked = [s.key for s in FACET_SPECS if f"<question> {s.question} </question>" in prompt]
        if asked:
            return f"<answer> {values[asked[0]]} </answer>"
        return "\n".join(f"<{key}>{value}</{key}>" for key, value in values.items())

    return answer


def stub_naming_completer() -> Callable[[str], str]:
    """Fails for one prompt hash in four and forgets the name for another."""

    def answer(prompt: str) -> str:
        digest = hashlib.md5(prompt.encode()).hexdigest()
        if digest[0] in "0123":
            raise RuntimeError("no answer")
        if digest[0] in "4567":
            return f"<summary>About {digest}.</summary>"
        return f"Sure.\n<Summary> About {digest}. </Summary>\n<NAME>\nName {digest}\n</NAME>"

    return answer
