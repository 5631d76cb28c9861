"""The lists a user would hand to the jobs, stated once for both engines."""

# Words not to count, an input of the word count and indexing jobs.
STOPWORDS = """
a about above after again against all also although am an and any are as at
be because been before being below between both but by
can cannot could
did do does doing down during
each either else ever every
few for from further
had has have having he her here hers herself him himself his how however
if in into is it its itself
just
may me might more most must my myself
neither no nor not now
of off on once one only or our ours ourselves out over own
per
same shall she should since so some such
than that the their theirs them themselves then there these they this those
through to too
under until up upon us
very
was we were what when where whether which while who whom whose why will with
within without would
yet you your yours yourself yourselves
""".split()

# The words of the co-occurrence matrix, an input of those jobs.
TOP_WORDS = """
der que die und des tion les den ein eau ment von sch tre eux elle ier aux ing
das ung ble mit ver thth ther sich une thon keit lich thre nci ber thor heit
thin auf thhe thed pour thnd thes est thha los thea erhe erer thti
""".split()

# The same with a Roman numeral, which can be met as a neighbour only.
TOP_WORDS_AND_NUMERAL = [*TOP_WORDS, "xii", "iii"]
