"""Rule catalogues and the plans that evaluate them."""
