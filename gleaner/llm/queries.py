"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

import functools

from gleaner.llm.centroid_clusters import op11_centroid_clusters
from gleaner.llm.clusters_sql import CLUSTERS_SQL
from gleaner.llm.common import find_package
from gleaner.llm.decontaminate import op4_decontamination
from gleaner.llm.jaccard_join import op8_jaccard_join
from gleaner.llm.lm_scoring import op3_lm_scoring
from gleaner.llm.mixing import op5_mixing
from gleaner.llm.pii import op7_pii
from gleaner.llm.quality_rules import op2_quality_rules
from gleaner.llm.ranked_search import RANKED_SQL, op12_ranked_search
from gleaner.llm.secret_scan import op9_secret_scan
from gleaner.llm.simhash_dedup import op13_simhash_neardup
from gleaner.llm.substring_dedup import op6_substring_dedup
from gleaner.llm.token_counts import op1_token_counts
from gleaner.llm.token_files import op10_token_files


def _registered(*fns):
    def ready(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            find_package(spark)
            return fn(spark, sf_dir)
        return run
    return {fn.__name__: ready(fn) for fn in fns}


QUERIES = _registered(op1_token_counts, op2_quality_rules, op3_lm_scoring, op4_decontamination, op5_mixing,
                      op6_substring_dedup, op7_pii, op8_jaccard_join, op9_secret_scan, op10_token_files,
                      op11_centroid_clusters, op12_ranked_search, op13_simhash_neardup)
ORACLE: dict[str, str] = {"op11_centroid_clusters": CLUSTERS_SQL, "op12_ranked_search": RANKED_SQL}
