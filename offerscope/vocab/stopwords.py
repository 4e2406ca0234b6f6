"""Stop words of the term scorer, as configuration."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover

# French function words (accents stripped).
FRENCH = frozenset("""
a ai au aux avec ce ces cet cette d dans de des du elle en et eux il ils je l la le les leur leurs lui ma mais me
meme mes moi mon ne nos notre nous on ou par pas pour qu que qui sa se ses son sur ta te tes toi ton tu un une vos
votre vous c y ete etre avoir fait faire plus tres tout tous toute toutes ainsi afin comme dont entre sein selon sous
chez vers lors etc via n s sont est sera serez seront peut pouvez ont avez nos notre leurs ceux celle celles cela
""".split())

# Words every advert uses.
RECRUITMENT = frozenset("""
poste postes profil profils mission missions equipe equipes entreprise societe groupe client clients candidat
candidate candidats recherche recherchons recrute recrutons rejoindre rejoignez offre offres h f hf cdi cdd stage
alternance experience experiences ans annee annees competences competence recherchees souhaitee souhaite requis
minimum possible jours jour semaine semaines selon politique interne travail teletravail hybride site remote full
salaire brut avantages formation diplome bac niveau junior senior confirme lead data donnees vos nos votre notre
role responsabilites principales construirez participerez accompagnerez fiabiliserez automatiserez conception mise
production projets projet metier metiers recrute un une
""".split())


def english() -> frozenset[str]:
    """The English list that ships with Spark (needs a running session)."""
    return frozenset(w for w in StopWordsRemover.loadDefaultStopWords("english") if "'" not in w)


def advert_stopwords() -> frozenset[str]:
    return FRENCH | RECRUITMENT | english()
