"""Ensemble settings as one validated parameter object.

Keys of the original settings file, as keyword parameters:
NUM_OF_TREES -> num_trees, NUM_OF_ATTRIBUTES_PER_TREE -> num_attributes,
CLASS_LABEL_INDEX -> label_index, ATTRIBUTE_NAMES -> attribute_names,
CLASS_LABEL_VALUES -> class_values, CLASS_LABEL_NAME -> label_name.
(The categorical-feature key was never read and is not kept.)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from canopy.operators.mltrees import num_attributes, num_trees

# ---- fixed values: setting keys of the original settings file -------------
KEYS = {
    "NUM_OF_TREES": "num_trees",
    "NUM_OF_ATTRIBUTES_PER_TREE": "num_attributes",
    "CLASS_LABEL_INDEX": "label_index",
    "ATTRIBUTE_NAMES": "attribute_names",
    "CLASS_LABEL_VALUES": "class_values",
    "CLASS_LABEL_NAME": "label_name",
}
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class EnsembleSettings:
    num_trees: int = 0                       # 0 -> default rule (M8)
    num_attributes: int = 0                  # 0 -> floor(sqrt(n)) (M9)
    label_index: int | None = None           # None -> last field
    attribute_names: tuple[str, ...] | None = None
    class_values: tuple[str, ...] | None = None
    label_name: str | None = None

    @classmethod
    def from_mapping(cls, values: Mapping[str, str]) -> EnsembleSettings:
        """Accept the original keys (upper case) or the field names."""
        kw: dict = {}
        for k, v in values.items():
            name = KEYS.get(k.strip(), k.strip())
            v = str(v).strip()
            if name in ("num_trees", "num_attributes", "label_index"):
                kw[name] = int(v)
            elif name in ("attribute_names", "class_values"):
                kw[name] = tuple(x.strip() for x in v.split(",") if x.strip())
            elif name == "label_name":
                kw[name] = v
        return cls(**kw)

    def validate(self, n_fields: int) -> None:
        """Check the settings against a row of ``n_fields`` fields."""
        li = self.label_index if self.label_index is not None else n_fields - 1
        if not 0 <= li < n_fields:
            raise ValueError(f"label index {li} outside 0..{n_fields - 1}")
        if self.attribute_names is not None and len(self.attribute_names) != n_fields - 1:
            raise ValueError(f"{len(self.attribute_names)} attribute names for {n_fields - 1} features")
        if self.num_trees < 0 or self.num_attributes < 0:
            raise ValueError("tree and attribute counts must be >= 0")

    def field_names(self, n_fields: int) -> list[str]:
        """Names of every field in file order (label included)."""
        self.validate(n_fields)
        li = self.label_index if self.label_index is not None else n_fields - 1
        feats = list(self.attribute_names) if self.attribute_names else [f"f{i}" for i in range(n_fields - 1)]
        label = self.label_name or "label_value"
        return feats[:li] + [label] + feats[li:]

    def trees(self) -> int:
        return num_trees(self.num_trees)

    def attributes(self, n_features: int) -> int:
        return num_attributes(self.num_attributes, n_features)

    def classes(self, n: int) -> Sequence[str]:
        return self.class_values if self.class_values else [str(float(i)) for i in range(n)]
