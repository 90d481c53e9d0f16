"""Domain vocabulary mining and text graphs on Spark DataFrames."""

from wordlode.plans.mine import MiningConfig, mine_vocabulary, run_job

__all__ = ["MiningConfig", "mine_vocabulary", "run_job"]
