"""litspark."""
