"""Plain-English result text as Spark Column expressions.

Everything is built from ``format_string`` / ``concat`` / ``when`` so the text
columns are computed JVM-side next to the numbers they describe.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# P-value display format.  Four decimals, and below this
# threshold a "below" phrase plus two-digit scientific notation.
P_DISPLAY_FLOOR = 1e-4
P_DECIMALS_FMT = "p = %.4f"
P_SMALL_FMT = "p < 0.0001 (%.2e)"
# Headline words for the two outcomes, and what parts them.
HEADLINE_SIGNIFICANT = "SIGNIFICANT DIFFERENCE"
HEADLINE_NOT_SIGNIFICANT = "NO SIGNIFICANT DIFFERENCE"
HEADLINE_BAR, HEADLINE_GAP = "   |   ", "   "

def _d(c) -> Column:
    return (c if isinstance(c, Column) else F.col(c)).cast("double")


def format_p(p) -> Column:
    """H5: ``p = 0.1234`` or ``p < 0.0001 (1.23e-05)``; NaN gives ``p = NaN``."""
    p = _d(p)
    return (F.when(F.isnan(p) | p.isNull(), F.lit("p = NaN"))
            .when(p < P_DISPLAY_FLOOR, F.format_string(P_SMALL_FMT, p))
            .otherwise(F.format_string(P_DECIMALS_FMT, p)))


def verdict_text(significant, p, alpha) -> Column:
    """H6: one sentence with the decision, the formatted p and alpha."""
    sig = significant if isinstance(significant, Column) else F.col(significant)
    a = _d(alpha).cast("string")
    return F.when(
        sig,
        F.concat(F.lit("The two groups differ significantly: "), format_p(p),
                 F.lit(" is below the significance level "), a, F.lit(".")),
    ).otherwise(
        F.concat(F.lit("No significant difference between the two groups: "),
                 format_p(p), F.lit(" is not below the significance level "),
                 a, F.lit(".")))


def interpretation_text(test_name, n1, n2, significant=None) -> Column:
    """H7: what the test compared and on how many observations."""
    tn = test_name if isinstance(test_name, Column) else F.lit(test_name)
    n1s = F.format_number(F.coalesce(_d(n1), F.lit(0.0)), 0)
    n2s = F.format_number(F.coalesce(_d(n2), F.lit(0.0)), 0)
    sig = (significant if isinstance(significant, Column) else
           (F.col(significant) if significant else F.lit(None).cast("boolean")))
    return (
        F.when(tn == "independent_ttest", F.concat(
            F.lit("Compares the means of two independent groups assuming a common "
                  "variance; groups of "), n1s, F.lit(" and "), n2s,
            F.lit(" observations.")))
        .when(tn == "welch_ttest", F.concat(
            F.lit("Compares the means of two independent groups without assuming "
                  "equal variances; groups of "), n1s, F.lit(" and "), n2s,
            F.lit(" observations.")))
        .when(tn == "paired_ttest", F.concat(
            F.lit("Tests whether the mean within-pair difference is zero; "), n1s,
            F.lit(" complete pairs.")))
        .when(tn == "mannwhitney", F.concat(
            F.lit("Rank-based comparison of two independent groups with no "
                  "normality assumption; groups of "), n1s, F.lit(" and "), n2s,
            F.lit(" observations.")))
        .when(tn == "chisquare", F.concat(
            F.lit("Compares observed with expected frequencies over "), n1s,
            F.lit(" observations; "),
            F.when(sig, F.lit("the pattern is unlikely under chance alone."))
            .otherwise(F.lit("the pattern is consistent with chance variation."))))
        .otherwise(F.lit(None).cast("string")))


def coverage_note(total_rows, rows_tested) -> Column:
    """H8: how many rows the statistics and the test used."""
    return F.concat(
        F.lit("Computed by Spark over all "), F.format_number(_d(total_rows), 0),
        F.lit(" usable rows; "), F.format_number(_d(rows_tested), 0),
        F.lit(" rows entered the test statistic."))


def headline_text(significant, test_name, p) -> Column:
    """Upper-case outcome, test name in title case, p to four decimals."""
    sig = significant if isinstance(significant, Column) else F.col(significant)
    tn = test_name if isinstance(test_name, Column) else F.lit(test_name)
    return F.concat_ws(
        HEADLINE_BAR,
        F.when(sig, F.lit(HEADLINE_SIGNIFICANT)).otherwise(F.lit(HEADLINE_NOT_SIGNIFICANT)),
        F.concat_ws(HEADLINE_GAP, F.initcap(F.regexp_replace(tn, "_", " ")),
                    F.when(_d(p).isNotNull(), F.format_string("p = %.4f", _d(p)))))


def normality_text(test_used, w, p, is_normal, n, max_n: int = 5000) -> Column:
    """Sentence for one normality check; ``max_n``: the largest group that gets a p-value."""
    return (
        F.when(test_used == "skipped_large_sample", F.concat(
            F.format_string("Shapiro-Wilk W = %.4f over ", _d(w)), F.format_number(_d(n), 0),
            F.lit(f" values; no p-value above {max_n:,}, normality assumed, inspect the Q-Q points.")))
        .when(test_used == "too_few_rows", F.concat(
            F.lit("Shapiro-Wilk needs at least 3 values, got "),
            F.format_number(F.coalesce(_d(n), F.lit(0.0)), 0), F.lit(".")))
        .otherwise(F.concat(
            F.format_string("Shapiro-Wilk W = %.4f, ", _d(w)), format_p(p),
            F.when(is_normal, F.lit(": consistent with a normal distribution."))
            .otherwise(F.lit(": departs from normality; a rank-based test is safer.")))))


def variance_text(w, p, equal) -> Column:
    """Sentence for the equal-variance check."""
    return F.concat(
        F.format_string("Levene (median) W = %.4f, ", _d(w)), format_p(p),
        F.when(equal, F.lit(": variances look equal."))
        .otherwise(F.lit(": variances differ; prefer the Welch t-test.")))


# Recommendation sentences, one per rule of H9.
REC_NON_NORMAL = ("At least one group is not normally distributed; the "
                  "Mann-Whitney U test is the rank-based alternative.")
REC_UNEQUAL_VAR = ("The group variances differ; the Welch t-test does not "
                   "assume equal variances.")
REC_PAIRED_NON_NORMAL = ("The paired differences are not normally distributed; "
                         "the Wilcoxon signed-rank test is the rank-based "
                         "alternative for paired data.")
