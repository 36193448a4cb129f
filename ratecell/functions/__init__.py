"""Column -> Column functions (null defaults, ratios, code maps, bands, prep)."""

from ratecell.functions.bands import (add_rate_change_bucket, band, cap_as_string, credit_band,
                                      interaction_key, km_annual_band, km_business_band,
                                      km_work_band, price_band, rate_change_band,
                                      rate_change_labels, rate_change_splits, veh_age_band)
from ratecell.functions.prep import DEFAULT_PREP, PrepSpec, classification_prep
from ratecell.functions.scalars import (coalesce_any, company_map, company_map_keep_null,
                                        fsa_normalize, fsa_strict, mandatory_only, nz, nz_num,
                                        nz_str, positive_flag, rate_change, ratio_or_null,
                                        ratio_or_zero, sum_null_safe_int, sum_nz, sum_strict)

__all__ = [
    "add_rate_change_bucket", "band", "cap_as_string", "credit_band", "interaction_key",
    "km_annual_band", "km_business_band", "km_work_band", "price_band", "rate_change_band",
    "rate_change_labels", "rate_change_splits", "veh_age_band", "DEFAULT_PREP", "PrepSpec",
    "classification_prep", "coalesce_any", "company_map", "company_map_keep_null",
    "fsa_normalize", "fsa_strict", "mandatory_only", "nz", "nz_num", "nz_str", "positive_flag",
    "rate_change", "ratio_or_null", "ratio_or_zero", "sum_null_safe_int", "sum_nz", "sum_strict",
]
