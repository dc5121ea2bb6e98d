"""Jobs on corpus tables, DataFrame to DataFrame."""
