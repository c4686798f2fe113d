"""Readers: action and dimension tables, job parameters, ad log streams."""
