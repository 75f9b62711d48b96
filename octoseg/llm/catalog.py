"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from octoseg.llm.cooccurrence import P1_SQL, p1_found, p1_pairs
from octoseg.llm.history_index import p6_checked, p6_found
from octoseg.llm.mixing import p9_found, p9_mix, p9_shares
from octoseg.llm.near_duplicates import p3_found, p3_groups
from octoseg.llm.neighbours import p2_found, p2_neighbours
from octoseg.llm.oracles import SIGNATURE_SQL
from octoseg.llm.quantiles import P5_SQL, p5_found, p5_percentiles
from octoseg.llm.similarity_clusters import p7_clusters, p7_found
from octoseg.llm.splitting import p10_found, p10_pieces
from octoseg.llm.tokenizer import p8_ids
from octoseg.runtime import Query

QUERIES: dict[str, Query] = {
    "p1_found": p1_found,
    "p1_pairs": p1_pairs,
    "p5_found": p5_found,
    "p5_percentiles": p5_percentiles,
    "p2_found": p2_found,
    "p2_neighbours": p2_neighbours,
    "p3_found": p3_found,
    "p3_groups": p3_groups,
    "p7_found": p7_found,
    "p7_clusters": p7_clusters,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_pieces": p10_pieces,
    "p6_found": p6_found,
    "p6_checked": p6_checked,
}
SQL: dict[str, str] = P1_SQL | P5_SQL | SIGNATURE_SQL
