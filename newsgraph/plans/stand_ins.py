"""Deterministic stand-ins for the language model, for the catalogue's
queries and the tests.  Not part of the operators."""

from __future__ import annotations

from collections.abc import Sequence

from newsgraph.operators.annotate import CLUSTER_MARKER, prompt_body

# Fixed patterns of the deterministic annotator.
STUB_PERSON_RE = r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?"
STUB_KEEP_RE = r"[^\p{L} ]"
STUB_WORD_RE = r"\p{L}+"


class StubAnnotator:
    """Deterministic stand-in for the model: text = letters and spaces of
    the whole article, topic = the first of ``topics`` found as a lower-cased
    word of the article (empty if none), persons = capitalised words, or two
    in a row, in text order."""

    def __init__(self, topics: Sequence[str]):
        self.topics = list(topics)

    def complete(self, system: str, prompt: str, max_tokens: int) -> str:
        import json

        import regex

        body = prompt_body(prompt)
        words = set(regex.findall(STUB_WORD_RE, body.lower()))
        topic = next((t for t in self.topics if t in words), "")
        text = regex.sub(STUB_KEEP_RE, "", body)
        persons = regex.findall(STUB_PERSON_RE, body)
        return "Ecco: " + json.dumps({"text": text, "topic": topic, "persons": persons},
                                     ensure_ascii=False) + " fine"


class FailingAnnotator(StubAnnotator):
    """The stand-in annotator, busy for texts whose length is a multiple of
    five."""

    def complete(self, system: str, prompt: str, max_tokens: int) -> str:
        if len(prompt_body(prompt)) % 5 == 0:
            raise RuntimeError("busy")
        return super().complete(system, prompt, max_tokens)


class StubSummarizer:
    """Deterministic summary: counts of words and full stops and the length
    of the longest word of the whole text."""

    def complete(self, system: str, prompt: str, max_tokens: int) -> str:
        import regex

        body = prompt_body(prompt)
        words = regex.findall(STUB_WORD_RE, body)
        longest = max((len(w) for w in words), default=0)
        return f"{len(words)} parole, {body.count('.')} punti, parola piu' lunga: {longest} lettere"


class StubCleaner:
    """Deterministic cleaning: keeps letters, digits, spaces and . , of the
    whole text."""

    def complete(self, system: str, prompt: str, max_tokens: int) -> str:
        import regex

        return regex.sub(r"[^\p{L}\p{N} .,]", "", prompt_body(prompt))


class StubClusterer:
    """Deterministic topic clustering: the label of a topic is its last
    word; members listed in the order given."""

    def complete(self, system: str, prompt: str, max_tokens: int) -> str:
        import json

        out: dict[str, list[str]] = {}
        for t in prompt_body(prompt, CLUSTER_MARKER).split("\n"):
            if t:
                out.setdefault(t.split()[-1] if t.split() else t, []).append(t)
        return "Here it is: " + json.dumps(out, ensure_ascii=False)
