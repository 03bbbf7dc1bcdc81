"""Names and phrases that web pages use for their parts."""

from __future__ import annotations

# --- fixed values: names that pages give to their parts, and what such parts say ----
CONTENT = "content article post entry story main text body page-content post-body entry-content article-body story-text single prose".split()
NAMES = {
    "menu": "nav menu navbar navigation main-nav top-menu breadcrumb breadcrumbs topbar tabs pagination pager toc".split(),
    "header": "header site-header masthead top page-header branding logo hero-bar".split(),
    "footer": "footer site-footer page-footer bottom colophon legal copyright credits".split(),
    "side": "sidebar side aside widget widgets secondary rail related related-posts recommended more-stories popular trending teaser".split(),
    "notice": "notice cookie cookie-banner consent gdpr alert banner popup modal overlay announcement message warning disclaimer paywall".split(),
    "advert": "ad ads advert advertisement adsense sponsored sponsor promo promoted promotion banner-ad commercial".split(),
    "form": "form search search-form newsletter subscribe signup login contact-form register".split(),
    "comments": "comments comment comment-list commentlist replies reply discussion responses disqus reader-comments feedback".split(),
    "share": "share sharing social social-links share-buttons tags tag-list byline-links".split(),
}
PHRASES = {
    "menu": "Home|About us|Contact|News|Sports|Archive|Menu|Next page|Previous|Start|Über uns|Kontakt|Accueil|Actualités|Inicio|Noticias|Products|Services|Blog|FAQ|Skip to content".split("|"),
    "header": "Welcome|Daily news and views|Your local source|Sign in|My account|Willkommen|Bienvenue|Bienvenido|Site name".split("|"),
    "footer": "© 2024 All rights reserved.|Copyright 2023|Privacy policy|Terms of use|Impressum|Datenschutz|Mentions légales|Aviso legal|Contact us|Powered by|Sitemap|Alle Rechte vorbehalten.|Tous droits réservés.|Todos los derechos reservados.".split("|"),
    "side": "Related articles|Most read|You may also like|Popular posts|Recent posts|Categories|Follow us|Mehr zum Thema|À lire aussi|Más leídas|Read more|Trending now".split("|"),
    "notice": "We use cookies to improve your experience.|This site uses cookies.|Accept all|By continuing you agree to our terms.|Wir verwenden Cookies.|Ce site utilise des cookies.|Usamos cookies.|Please enable JavaScript.|Breaking: service may be interrupted tonight.|You have read your last free article.".split("|"),
    "advert": "Advertisement|Sponsored|Buy now and save|Anzeige|Publicité|Publicidad|Limited offer, order today!|Learn more|Shop the sale".split("|"),
    "form": "Subscribe to our newsletter|Enter your email|Your name|Search|Log in|Password|Submit|Send|Abonnieren|S'abonner|Suscribirse|Leave a message".split("|"),
    "comments": "Comments|Leave a reply|3 comments|Reply|Add a comment|Kommentare|Commentaires|Comentarios|Posted by reader|Report abuse|2 hours ago".split("|"),
    "share": "Share this|Tweet|Like|Share on social media|Tags|Print|Email this|Teilen|Partager|Compartir".split("|"),
}

# words that by themselves hint at a part
CUES = frozenset(w for said in PHRASES.values() for p in said for w in p.strip(".,:;!?").lower().split() if len(w) > 3)


def _roles() -> dict[str, str]:
    """The part that a name's word stands for: ``other`` if several, none if the main text may be among them."""
    seen: dict[str, set[str]] = {}
    for role, names in {"content": CONTENT, **NAMES}.items():
        for word in {w for name in names for w in name.split("-")}:
            seen.setdefault(word, set()).add(role)
    alone = {word: roles for word, roles in seen.items() if len(roles) == 1 or "content" not in roles}
    return {word: next(iter(roles)) if len(roles) == 1 else "other" for word, roles in alone.items()}


ROLES = _roles()
