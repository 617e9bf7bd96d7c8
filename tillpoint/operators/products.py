"""Product revenue: per stock code, non-product codes, profitable / loss lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import money_sum
from ..schema import NON_PRODUCT_CODES, TOTAL
from .filters import non_product


def product_revenue(clean: DataFrame, key: str = "StockCode", value: str = "Net_Revenue",
                    sort: bool = True) -> DataFrame:
    """A1: net revenue per product code, highest first (NULL codes dropped)."""
    out = (clean.filter(F.col(key).isNotNull())
           .groupBy(key).agg(money_sum(value, TOTAL).alias(value)))
    return out.orderBy(F.col(value).desc(), F.col(key)) if sort else out


def worst_products(clean: DataFrame, k: int = 20, key: str = "StockCode", value: str = "Net_Revenue") -> DataFrame:
    """A1 tail: the k lowest net revenues (a top-k, not a full sort)."""
    return product_revenue(clean, key, value, sort=False).orderBy(F.col(value).asc(), F.col(key)).limit(k)


def non_product_revenue(clean: DataFrame, codes=NON_PRODUCT_CODES, key: str = "StockCode",
                        value: str = "Net_Revenue") -> DataFrame:
    """A3: revenue of fee / adjustment codes (only codes that occur)."""
    rows = clean.filter(non_product(key, codes))
    return product_revenue(rows, key, value)


def real_product_revenue(clean: DataFrame, codes=NON_PRODUCT_CODES, key: str = "StockCode",
                         value: str = "Net_Revenue") -> DataFrame:
    return product_revenue(clean.filter(~non_product(key, codes)), key, value, sort=False)


@dataclass(frozen=True)
class ProductAnalysis:
    top_profitable: DataFrame
    top_losses: DataFrame
    counts: DataFrame


def analyze_products(clean: DataFrame, k: int = 10, losses: str = "largest", codes=NON_PRODUCT_CODES,
                     key: str = "StockCode", value: str = "Net_Revenue") -> ProductAnalysis:
    """A4: top-k profitable, top-k loss products and both counts.

    losses='largest': the most negative first. losses='script': the first k
    of the descending list, i.e. the losses closest to zero.
    Each list is a top-k over the product aggregate (bounded per-task heaps);
    the counts are one conditional aggregate.
    """
    real = real_product_revenue(clean, codes, key, value)
    v = F.col(value)
    top = real.filter(v > 0).orderBy(v.desc(), F.col(key)).limit(k)
    if losses == "largest":
        low = real.filter(v < 0).orderBy(v.asc(), F.col(key)).limit(k)
    elif losses == "script":
        low = real.filter(v < 0).orderBy(v.desc(), F.col(key)).limit(k)
    else:
        raise ValueError(f"unknown losses order {losses!r}")
    counts = real.agg(F.count_if(v > 0).alias("profitable"), F.count_if(v < 0).alias("loss"))
    return ProductAnalysis(top, low, counts)


def code_lookup(clean: DataFrame, code: str, key: str = "StockCode") -> DataFrame:
    """every line of one stock code."""
    return clean.filter(F.col(key) == F.lit(code))
