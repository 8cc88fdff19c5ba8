"""The registered queries of this folder and the SQL they must equal."""

from __future__ import annotations

from ..catalog import Registry
from .collocations import COLLOCATIONS_SQL, collocations
from .common import documents, llm_query
from .de_bruijn_dedup import SUBSTRING_SQL, de_bruijn_dedup
from .decontamination import overlaps
from .jaccard_join import jaccard_join
from .language_id import language_id
from .lm_scoring import lm_scoring
from .mixing import MIXING_SQL, mixing_report
from .packing import pack
from .quality_rules import quality_rules
from .ranked_search import SEARCH_SQL, ranked_search
from .secret_scan import secret_scan
from .sharding import sharding
from .suffix_dedup import suffix_dedup

query = Registry()


@llm_query(query, "op2_quality_rules")
def op2(spark, sf_dir):
    """Counters and verdict of every document."""
    return quality_rules(documents(spark, sf_dir))


@llm_query(query, "op4_source_mixing", MIXING_SQL)
def op4(spark, sf_dir):
    """Words the mix takes from every document."""
    return mixing_report(documents(spark, sf_dir))


@llm_query(query, "op7_sharding")
def op7(spark, sf_dir):
    """Shard and slot of every document."""
    return sharding(documents(spark, sf_dir))


@llm_query(query, "op1_suffix_dedup")
def op1(spark, sf_dir):
    """Bytes of every document that a smaller document has in a common string of 50 bytes."""
    return suffix_dedup(documents(spark, sf_dir))


@llm_query(query, "op8_de_bruijn_dedup", SUBSTRING_SQL)
def op8(spark, sf_dir):
    """Words of every document that an earlier window of 20 words covers."""
    return de_bruijn_dedup(documents(spark, sf_dir))


@llm_query(query, "op5_secret_scan")
def op5(spark, sf_dir):
    """Spans of secrets in every document."""
    return secret_scan(documents(spark, sf_dir))


@llm_query(query, "op9_language_id")
def op9(spark, sf_dir):
    """Predicted language of every document."""
    return language_id(documents(spark, sf_dir))


@llm_query(query, "op10_decontamination")
def op10(spark, sf_dir):
    """Documents that hold a benchmark item, with the words that match."""
    return overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@llm_query(query, "op6_lm_scoring")
def op6(spark, sf_dir):
    """Scores of every document by the word model and the subword lattice."""
    return lm_scoring(documents(spark, sf_dir))


@llm_query(query, "op3_jaccard_join")
def op3(spark, sf_dir):
    """Shingles and component of every document."""
    return jaccard_join(documents(spark, sf_dir))


@llm_query(query, "op11_packing")
def op11(spark, sf_dir):
    """Pieces of every document and the sequences they lie in."""
    return pack(documents(spark, sf_dir))


@llm_query(query, "op12_ranked_search", SEARCH_SQL)
def op12(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    return ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@llm_query(query, "op13_collocations", COLLOCATIONS_SQL)
def op13(spark, sf_dir):
    """The best phrases of every language."""
    return collocations(documents(spark, sf_dir))
