"""Versioned lexicons and classification rules, loaded from JSON files or built in code."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import cached_property
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import normalized

TIERS = ("E", "R", "W", "S")  # by rank
#: A classification symbol: subclass, main group, subgroup.
SYMBOL = r"([A-HY]\d{2}[A-Z])\s*(\d+)\s*/\s*(\d+)"


@dataclass(frozen=True)
class Taxonomy:
    """`docs` and `ipc` are the two files' contents."""

    docs: dict
    ipc: dict

    @property
    def version(self) -> str:
        return f"docs-{self.docs['taxonomy_version']}__ipc-{self.ipc['taxonomy_version']}"

    @property
    def window(self) -> int:
        return int(self.docs.get("normalization", {}).get("context_window_chars", 48))

    @cached_property
    def terms(self) -> dict[str, dict]:
        """Normalised keyword -> its group; tier E is the default and never matched."""
        return {normalized(k): g for g in self.docs["term_groups"] if g["tier"] != "E" for k in g["keywords"]}

    @cached_property
    def contexts(self) -> list[tuple[dict, list[str]]]:
        """(lexicon, normalised keywords, longest first)."""
        return [(c, sorted({normalized(k) for k in c["keywords"]}, key=lambda k: (-len(k), k))) for c in self.docs["context_lexicons"]]

    @cached_property
    def diagnostics(self) -> dict[str, dict]:
        return {normalized(k): p for p in self.docs.get("diagnostic_patterns", []) for k in p["keywords"]}

    @cached_property
    def rules(self) -> list[dict]:
        out = []
        for rule in self.ipc["rules"]:
            found = re.fullmatch(SYMBOL, rule["symbol"].upper())
            if not found:
                raise ValueError(f"not a classification symbol: {rule['symbol']}")
            sub = found[3]
            out.append({**rule, "subclass": found[1], "main_group": int(found[2]), "subgroup": sub, "specificity": len(sub.rstrip("0")) * 2 + (rule["match"] == "exact")})
        return out

    def problems(self, sources: set[str] | None = None) -> list[str]:
        """Integrity: keywords in one group only, rule ids once, sources that exist, known tiers."""
        out, seen = [], {}
        for g in self.docs["term_groups"]:
            if g["tier"] not in TIERS:
                out.append(f"{g['id']}: tier {g['tier']}")
            for k in map(normalized, g["keywords"]):
                if seen.setdefault(k, g["id"]) != g["id"]:
                    out.append(f"keyword {k} in {seen[k]} and {g['id']}")
        ids = [r["id"] for r in self.ipc["rules"]]
        out += [f"rule {i} twice" for i in sorted({i for i in ids if ids.count(i) > 1})]
        if sources is not None:
            for entry in [*self.docs["term_groups"], *self.docs["context_lexicons"], *self.docs.get("diagnostic_patterns", []), *self.ipc["rules"]]:
                out += [f"{entry['id']}: unknown source {s}" for s in entry.get("source_ids", []) if s not in sources]
        return out

    def term_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(g["id"], g["tier"], k, g["match_policy"]["mode"], g["match_policy"].get("required_any", []), g.get("source_ids", [])) for k, g in self.terms.items()]
        return spark.createDataFrame(rows, "group_id string, tier string, keyword string, mode string, required_any array<string>, source_ids array<string>")

    def rule_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(r["id"], r["tier"], r["symbol"], r["match"], r["subclass"], r["main_group"], r["subgroup"], r["specificity"], n, r.get("editions", []), r.get("source_ids", [])) for n, r in enumerate(self.rules)]
        return spark.createDataFrame(rows, "rule_id string, tier string, symbol string, match string, subclass string, main_group int, subgroup string, specificity int, position int, editions array<string>, source_ids array<string>")


def _json(path: str | Path) -> dict:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def load_taxonomy(lexicon: str | Path, codes: str | Path) -> Taxonomy:
    """From the file of term groups, contexts and diagnostics, and the file of code rules."""
    return Taxonomy(_json(lexicon), _json(codes))


def load_sources(path: str | Path) -> set[str]:
    """Ids of the sources that lexicons cite."""
    return {s["id"] for s in _json(path)["sources"]}


def sample_taxonomy() -> Taxonomy:
    """A small Latin lexicon for tables without the domain's own language."""
    group = lambda i, tier, words, mode="standalone_phrase", **more: {"id": i, "tier": tier, "keywords": words, "source_ids": ["SRC-1"], "match_policy": {"mode": mode, **more}}
    docs = {
        "taxonomy_version": "0.1",
        "normalization": {"context_window_chars": 48},
        "term_groups": [group("S-LICENSE", "S", ["apache license", "license"]), group("W-TOKEN", "W", ["token", "mit license"]), group("R-TION", "R", ["ention", "anon"]), group("R-GATED", "R", ["thnd"], "cooccurrence", required_any=["CTX-A"]), group("E-NONE", "E", ["the"])],
        "context_lexicons": [{"id": "CTX-A", "kind": "object", "keywords": ["on the", "on", "version"], "source_ids": ["SRC-1"]}, {"id": "CTX-B", "kind": "goal", "keywords": ["under", "ered"], "source_ids": ["SRC-1"]}],
        "diagnostic_patterns": [{"id": "DIAG-1", "kind": "neighbour", "keywords": ["copyright", "erin"], "effect": "record_only"}],
    }
    rule = lambda i, tier, symbol, match="subtree": {"id": i, "tier": tier, "symbol": symbol, "match": match, "editions": [], "source_ids": ["SRC-1"]}
    ipc = {"taxonomy_version": "0.1", "rules": [rule("I1", "S", "G06F 21/60", "exact"), rule("I2", "W", "G06F 21/00"), rule("I3", "R", "G06F 11/00"), rule("I4", "W", "G06F 21/30"), rule("I5", "R", "G06F 3/06"), rule("I6", "S", "G06F 9/4")]}
    return Taxonomy(docs, ipc)
