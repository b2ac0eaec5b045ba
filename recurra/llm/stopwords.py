"""Frequent function words of the languages that the block rules and the language guess know."""

# Articles, pronouns, prepositions, conjunctions and auxiliaries, lower-case.
STOP_WORDS = {
    "de": frozenset(
        "aber als am an auch auf aus bei bin bis da das dass dem den der des die doch du durch ein eine einem einen einer "
        "eines er es für haben hat hatte ich ihr im in ist ja kann mehr mich mir mit nach nicht noch nur oder sein sich sie "
        "sind so über um und uns unter vom von vor war was wenn werden wie wir wird zu zum zur".split()
    ),
    "en": frozenset(
        "a about all also an and any are as at be been but by can could do for from had has have he her his how i if in into "
        "is it its just like more most my no not of on one only or other our out she so some such than that the their them "
        "then there these they this to up was we were what when which who will with would you your".split()
    ),
    "es": frozenset(
        "a al algo ante antes como con cuando de del desde donde dos el ella ellos en entre era es esa ese esta este esto "
        "fue ha hasta hay la las le les lo los mas me mi muy más ni no nos o otra otro para pero por porque que quien se "
        "ser si sin sobre su sus sí también tan te todo un una uno y ya yo".split()
    ),
    "fr": frozenset(
        "ai au aux avec ce ces cette comme d dans de des du elle elles en est et eux il ils j je l la le les leur lui ma "
        "mais me mes moi mon même ne nos notre nous on ou où par pas plus pour qu que qui s sa sans se ses si son sont sur "
        "ta te tes toi ton tu un une vos votre vous y à été être".split()
    ),
}
ALL_STOP_WORDS = frozenset().union(*STOP_WORDS.values())
