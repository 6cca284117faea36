"""Parameters of a family analysis: contract, defaults, validation, default label."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, fields
from typing import Any, Literal, get_args, get_origin, get_type_hints


@dataclass(frozen=True)
class ClusterParams:
    """What a family analysis can be asked for; the annotations are the contract, ranges are not enforced."""

    datasetRef: str | None = None
    sequencesRef: list[str] = field(default_factory=list)
    sequenceType: Literal["aminoacid", "nucleotide"] = "aminoacid"
    identity: float = 0.8
    similarityType: Literal["sequence-identity", "blosum40", "blosum50", "blosum62", "blosum80", "blosum90"] = "blosum62"
    coverageThreshold: float = 0.8
    coverageMode: Literal[0, 1, 2, 3, 4, 5] = 0
    highPrecision: bool = False
    trimStart: float = 0
    trimEnd: float = 0
    clusteringTool: Literal["easy-cluster", "easy-linclust"] = "easy-cluster"
    consensusThreshold: float = 0.6
    gapThreshold: float = 0.5
    centroidAlignment: Literal["auto", "gapped", "ungapped"] = "auto"
    weightByAbundance: bool = False
    generateDataset: bool = False
    mem: float = 32
    cpu: float = 16
    customBlockLabel: str | None = None
    #: An option of this library, which stored records don't carry.
    keepGaps: bool = field(default=False, metadata={"stored": False})

    @classmethod
    def _stored(cls) -> dict[str, Any]:
        hints = get_type_hints(cls)
        return {f.name: hints[f.name] for f in fields(cls) if f.metadata.get("stored", True)}

    @classmethod
    def from_dict(cls, given: dict[str, Any]) -> ClusterParams:
        """Unknown keys are dropped, absent (or None) ones keep their defaults, a value against its annotation raises ValueError."""
        if not isinstance(given, dict):
            raise ValueError(f"parameters come as a dict, not as {type(given).__name__}")
        chosen = {name: given[name] for name in cls._stored() if given.get(name) is not None}
        if wrong := [name for name, value in chosen.items() if not _conforms(value, cls._stored()[name])]:
            raise ValueError("unfit values: " + ", ".join(f"{name}={chosen[name]!r}" for name in wrong))
        return cls(**chosen)

    @classmethod
    def upgrade(cls, old: dict[str, Any]) -> ClusterParams:
        """Older records: `alignment-score` means blosum62, and centroids were aligned with gaps."""
        new = {"centroidAlignment": "gapped", **old}
        if new.get("similarityType") == "alignment-score":
            new["similarityType"] = "blosum62"
        return cls.from_dict(new)

    def to_dict(self) -> dict[str, Any]:
        """Inverse of from_dict: only what differs from the defaults."""
        default = ClusterParams()
        return {f.name: v for f in fields(self) if f.name in self._stored() and (v := asdict(self)[f.name]) != getattr(default, f.name)}

    def runnable(self) -> None:
        if not self.datasetRef:
            raise ValueError("a dataset is needed.")
        if not self.sequencesRef:
            raise ValueError("a sequence column is needed.")

    def effective(self) -> ClusterParams:
        """high precision doesn't go with linear-time clustering."""
        if self.clusteringTool == "easy-linclust" and self.highPrecision:
            return ClusterParams(**{**asdict(self), "highPrecision": False})
        return self

    def label(self, sequence_labels: tuple[str, ...] = ()) -> str:
        """Custom label, or one made of what was chosen: what is left at its default and has no number is not named."""
        if self.customBlockLabel:
            return self.customBlockLabel
        told = {
            " - ".join(sequence_labels): bool(sequence_labels),
            "Exact Match" if self.similarityType == "sequence-identity" else self.similarityType.upper(): True,
            f"ident:{self.identity:g}": True,
            f"cov:{self.coverageThreshold:g}": True,
            f"trimStart: {self.trimStart:g}": self.trimStart > 0,
            f"trimEnd: {self.trimEnd:g}": self.trimEnd > 0,
            self.centroidAlignment: self.centroidAlignment != "auto",
        }
        return ", ".join(text for text, wanted in told.items() if wanted)


def _conforms(value: Any, kind: Any) -> bool:
    """Whether a value fits an annotation; whole numbers are floats too, booleans aren't numbers."""
    if get_origin(kind) is Literal:
        return any(value == x and isinstance(value, bool) == isinstance(x, bool) for x in get_args(kind))
    if get_origin(kind) is list:
        return isinstance(value, list) and all(_conforms(x, get_args(kind)[0]) for x in value)
    if inner := get_args(kind):
        return any(_conforms(value, k) for k in inner)
    if kind is float:
        return isinstance(value, int | float) and not isinstance(value, bool)
    return isinstance(value, kind)


def suggest_similarity(labels: list[str]) -> str:
    """BLOSUM80 where every chosen sequence is a framework region, else BLOSUM62."""
    low = [x.lower() for x in labels]
    return "blosum80" if low and all("fr" in x and "cdr3" not in x for x in low) else "blosum62"


def prune_selection(selected: list[str], valid: list[str]) -> list[str]:
    """Selected options that still exist."""
    known = set(valid)
    return [x for x in selected if x in known]


def warnings(input_empty: bool, min_length: int | None, peptide: bool) -> list[str]:
    out = []
    if input_empty:
        out.append("The input dataset is empty.")
    elif peptide and min_length is not None and min_length < 5:
        out.append("Peptides shorter than 5 residues have few seeds or none; they are compared by edit distance.")
    return out
