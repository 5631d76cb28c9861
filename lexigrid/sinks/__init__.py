from lexigrid.sinks.text import (
    encode_stripe,
    render_pairs,
    render_ranked,
    render_scores,
    render_stripes,
    render_tsv,
    stripe_text,
    write_lines,
)

__all__ = ["encode_stripe", "render_pairs", "render_ranked", "render_scores", "render_stripes", "render_tsv", "stripe_text", "write_lines"]
