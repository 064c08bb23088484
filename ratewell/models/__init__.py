"""Count and rate models whose training is spread over the rows."""
