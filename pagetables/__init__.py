"""pagetables: raw web pages in, validated article tables and quality reports out, all as Spark DataFrames."""
