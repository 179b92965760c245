"""DuckDB SQL answering each registered query from the same tables, written independently."""

from oracle.gold_sql import gold_oracle
from oracle.layers_sql import layers_oracle
from oracle.text_sql import text_oracle


def all_oracles() -> dict[str, str]:
    return {**gold_oracle(), **layers_oracle(), **text_oracle()}
