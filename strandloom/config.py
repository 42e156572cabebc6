"""Settings of the four steps, with presets."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Config:
    # What the steps' results depend on.
    min_mapq: int = 40
    evidence_mapq: int = 40
    min_clip: int = 12
    min_clean_clip: int = 10
    min_aligned: int = 40
    min_evidence_reads: int = 2
    min_adapter: int = 4
    adapter_stop: int = 10
    min_g_run: int = 5
    adapters: tuple[str, ...] = (
        "AGATCGGAAGAGCACACGTCTGAACTCCAGTCA",
        "AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGT",
        "AGATCGGAAAGCACACGTCTGAACTCCAGTCA",
        "AGATCGGAAAGCGTCGTGTAGGGAAAGAGTGT",
    )
    same_contig_supplementary: int = 1000
    cluster_gap: int = 6
    pair_least: int = 2
    pair_most: int = 40
    polya_run: int = 12
    polya_near: int = 12
    polya_far: int = 120
    rescue_run: int = 8
    kmer: int = 12
    match_score: float = 0.6
    bin_width: int = 100
    bin_hot: int = 4
    bin_margin: int = 50
    remap_distance: int = 1000
    max_coverage: int = 60
    max_insertions_per_file: int = 1_000_000
    max_contig_name: int = 5
    min_wild_types: int = 20
    min_insertions: int = 1
    max_artefact: int = 0
    max_na: int = 0
    min_best_score: int = 1000
    # Options: how much of the historical behaviour is kept.
    left_double_vote: bool = True
    double_reference_uses_alt: bool = True
    strict_offset: bool = False


MOUSE = Config()
HUMAN = replace(MOUSE, min_mapq=60, min_wild_types=0, max_artefact=24, max_na=24)
MOUSE_COLONIES = replace(MOUSE, min_mapq=60, max_artefact=200, max_na=18)
