"""Learned by ``quality_training`` from 16000 written documents; not edited by hand."""

RULES = [
    ('junk', [('distinct_share', '<=', 0.3542), ('distinct_share', '<=', 0.2374), ('distinct_share', '<=', 0.126)]),
    ('junk', [('symbol_share', '>', 0.1442), ('letter_share', '<=', 0.4479)]),
    ('junk', [('vowel_share', '<=', 0.25), ('letter_share', '>', 0.7598), ('vowel_share', '<=', 0.2341)]),
    ('junk', [('mixed_token_share', '>', 0.337)]),
    ('junk', [('distinct_share', '<=', 0.213), ('letter_share', '>', 0.9903)]),
    ('junk', [('distinct_share', '<=', 0.2249), ('mixed_token_share', '<=', 0.001), ('symbol_share', '>', 0.0181)]),
    ('junk', [('vowel_share', '>', 0.3218), ('distinct_share', '<=', 0.4139), ('distinct_share', '<=', 0.2787)]),
    ('table', [('digit_share', '>', 0.1091), ('digit_share', '>', 0.3327), ('field_share', '<=', 0.5), ('digit_share', '>', 0.359), ('common_share', '<=', 0.1667)]),
    ('table', [('digit_share', '>', 0.1058), ('column_line_share', '>', 0.6667), ('field_share', '<=', 0.5), ('symbol_share', '>', 0.0808)]),
    ('table', [('clock_line_share', '>', 0.5)]),
    ('table', [('digit_share', '>', 0.2004), ('symbol_share', '<=', 0.0431), ('column_line_share', '>', 0.5)]),
    ('table', [('column_line_share', '>', 0.9012), ('digit_share', '>', 0.0865), ('field_share', '<=', 0.5), ('digit_share', '>', 0.1685)]),
    ('table', [('symbol_share', '>', 0.0709), ('symbol_share', '<=', 0.0808), ('column_line_share', '>', 0.6875), ('field_share', '<=', 0.0938)]),
    ('list', [('common_share', '<=', 0.0172), ('punctuated_line_share', '<=', 0.1169), ('symbol_share', '>', 0.0224), ('sentence_end_share', '<=', 0.0268)]),
    ('list', [('common_share', '<=', 0.0135), ('punctuated_line_share', '<=', 0.0508), ('symbol_share', '>', 0.0015), ('digit_share', '>', 0.0145), ('symbol_share', '>', 0.008)]),
    ('list', [('common_share', '<=', 0.0486), ('sentence_end_share', '<=', 0.0185), ('words_per_item', '<=', 2.3734), ('common_share', '<=', 0.0041), ('digit_share', '<=', 0.0073)]),
    ('list', [('common_share', '<=', 0.0478), ('punctuated_line_share', '<=', 0.0508), ('words_per_item', '<=', 2.8512), ('digit_share', '>', 0.036)]),
    ('list', [('common_share', '<=', 0.0678), ('words_per_item', '<=', 2.0228), ('sentence_end_share', '<=', 0.0204), ('symbol_share', '>', 0.0)]),
]
DEFAULT_KIND = 'prose'
