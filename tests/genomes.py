"""Synthetic genomes: two lineages, each with isolates that differ in a few places."""

import random

from octoseg.config import SEGMENTS, TABLE

SEGMENT_LENGTHS = {row[0]: row[4:] for row in TABLE}


def genomes(per_lineage: int = 6, rate: float = 0.0002, apart: float = 0.12, seed: int = 100, names: str = "iso") -> list[tuple[str, str]]:
    """(header, sequence) records of all eight segments."""
    rng = random.Random(seed)

    def changed(s: str, share: float) -> str:
        out = list(s)
        for i in range(len(out)):
            if rng.random() < share:
                out[i] = rng.choice("ACGT")
        return "".join(out)

    base = {s: "".join(rng.choice("ACGT") for _ in range(sum(SEGMENT_LENGTHS[s]) // 2)) for s in SEGMENTS}
    lineages = [base, {s: changed(v, apart) for s, v in base.items()}]
    rng = random.Random(seed + sum(map(ord, names)))
    out = []
    for li, lineage in enumerate(lineages):
        for i in range(per_lineage):
            for n, s in enumerate(SEGMENTS, 1):
                out.append((f"{names}{'AB'[li]}{i:02d}_segment_{n}_H3N2_2024-01-05", changed(lineage[s], rate)))
    return out
