"""Column-level helpers: special functions, p-value UDFs, binning and text."""
