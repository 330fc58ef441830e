"""quarry: batch analytics operators and analyses on Spark DataFrames.

Where to start:
  quarry.session.get_session          a session with the planner defaults
  quarry.sources.formats              read the reference's input files into role columns
  quarry.sources                      delimited / CSV / term-list readers, writers, parquet stage
  quarry.operators                    attach, unique_lookup, exclude_terms, mean_count(_wide), count_by,
                                      best_of, biggest_gap, top_k_per_group, collect_top_k, dense ranks
  quarry.functions                    column helpers (trim, tokenise, age bands, parsing, rounding)
  quarry.plans.ratings / text_insights / commerce
                                      the analyses (movie, genre, gender, age, occupation, year;
                                      review text; orders, revenue, delivery, sellers)
  quarry.streaming                    incremental per-movie statistics with Structured Streaming
"""

__version__ = "0.1.0"
