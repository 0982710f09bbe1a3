"""lexiframe: analytics over keyed message catalogues and text corpora, as Spark DataFrames."""
