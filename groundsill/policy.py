"""Tunable settings as frozen dataclasses. Jobs turn them into literals, never into joins."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class GateConfig:
    """What a request must satisfy before it is searched."""

    min_query_chars: int = 10
    min_query_tokens: int = 2
    min_alpha_token_ratio: float = 0.6
    max_query_chars: int = 500
    max_request_id_chars: int = 64
    default_top_k: int = 5
    max_top_k: int = 20
    candidate_multiplier: int = 5

    @property
    def max_candidates(self) -> int:
        """Upper bound of candidates any one request can have."""
        return self.max_top_k * self.candidate_multiplier


@dataclass(frozen=True)
class RetrievalConfig:
    """Thresholds applied to searched candidates."""

    min_similarity: float = 0.76
    soft_similarity: float = 0.85
    soft_similarity_by_type: dict[str, float] = field(default_factory=dict)
    strong_similarity_floor: float = 0.50
    min_strong_hits: int = 1
    max_similarity_gap: float = 0.40


@dataclass(frozen=True)
class SelectionPolicy:
    """How evidence is chosen from candidates."""

    min_top_similarity: float = 0.76
    min_chunk_similarity: float = 0.76
    max_chunks: int = 6
    max_chunks_per_knowledge_id: int = 2
    max_evidence_tokens: int = 2200
    reserved_output_tokens: int = 800
    max_total_prompt_tokens: int = 3500
    max_context_tokens: int = 128000
    max_chunk_token_ratio: float = 0.35
    overlap_ratio_threshold: float = 0.80
    policy_version: str = "R2_POLICY_V1"

    @property
    def per_chunk_tokens(self) -> int:
        return int(self.max_chunk_token_ratio * self.max_evidence_tokens)


@dataclass(frozen=True)
class EmbeddingPin:
    """The one model slice an index version is built from."""

    model_name: str
    model_version: str
    dimension: int


@dataclass(frozen=True)
class RunLimits:
    """When an embedding run is reported as unhealthy."""

    max_failure_rate: float = 0.02
    max_quarantine_rate: float = 0.10
    max_p95_latency_ms: int = 2000
    cost_per_1k_tokens: float = 0.00013
    batch_size: int = 50
    batch_cap: int = 100
