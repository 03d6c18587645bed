"""The datasets: pure functions from DataFrames to DataFrames, and the build over them."""
