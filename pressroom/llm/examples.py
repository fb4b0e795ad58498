"""Labelled pages: small examples of common page layouts. ``data-main`` marks the element that holds the article."""

LABELLED_PAGES = (
    """<html><head><title>Harbour bridge opens</title></head><body class="single"><header class="site-header"><a href="/">The Daily Example</a>
<nav><ul><li><a href="/a">News</a></li><li><a href="/b">Sport</a></li><li><a href="/c">Weather</a></li></ul></nav></header>
<div class="cookie-notice">We use cookies to give you the best experience. <button>Accept</button></div>
<div id="wrapper"><div class="post-content" data-main><h1>Harbour bridge opens after six years of work</h1><p class="byline">By A. Writer, 3 May</p>
<p>The new bridge over the harbour was opened on Monday morning, six years after the first stone was laid, and several thousand people walked over it.</p>
<div class="ad">Buy one, get one free at the corner shop</div>
<p>The mayor said that the town had waited long enough. Traffic will be allowed from Thursday on.</p><h2>What it costs</h2>
<p>Three things made the work dearer than planned:</p><ul><li>the price of steel, which doubled within a year;</li><li>a flood in the second winter;</li><li>an old wreck below the northern pier.</li></ul>
<blockquote>Nobody could have known about the wreck before the digging began.</blockquote></div>
<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Ten walks for the weekend</a></li><li><a href="/2">Where to eat fish</a></li></ul></aside></div>
<div id="comments"><h3>2 comments</h3><div class="comment"><p>I was there on Monday and it was wonderful, but far too many people came at once.</p></div><div class="comment"><p>Too dear, if you ask me. The old one was good enough for everybody.</p></div></div>
<form action="/search"><label>Search the archive</label><input name="q"></form><footer><p>Copyright The Daily Example. All rights reserved.</p></footer></body></html>""",
    """<html><body><table><tr><td class="menu"><a href="1">Home</a><br><a href="2">About us</a><br><a href="3">Contact</a></td><td data-main><h2>How to sharpen a knife</h2>
<p>Lay the stone on a wet cloth so that it can't slide. Hold the blade at about fifteen degrees and draw it over the stone as if you were cutting a thin slice off it.</p>
<p>Turn the blade over after ten strokes. When you feel a burr along the whole edge, go on with the finer side of the stone.</p><p>Rinse it.</p></td>
<td class="banner">Cheap flights from 19.99</td></tr></table><p align="center"><a href="imprint">Imprint</a> | <a href="privacy">Privacy</a> | webmaster@example.org</p></body></html>""",
    """<html><body><div role="navigation"><a href="#x">Skip to content</a> <a href="/">Start</a> <a href="/blog">Blog</a></div><main><div class="notice">This page was last checked a year ago.</div>
<div data-main><h1>Notes on bread</h1><p>Flour, water, salt and time are all it takes. The longer the dough may rest in a cool place, the more taste the bread will have.</p>
<pre>500 g flour
350 g water
10 g salt</pre><p>Mix, wait for an hour, fold. Do that three times.</p><figure><img src="a.jpg"><figcaption>The loaf after forty minutes in the oven.</figcaption></figure></div>
<div class="share"><a href="t">Share</a> <a href="u">Send</a></div><section class="related"><h2>Related</h2><p><a href="/r">Notes on butter: how it is made and how it is kept</a></p></section></main>
<div class="newsletter"><p>Sign up for our newsletter and never miss a recipe again.</p><form><input><button>Sign up</button></form></div><footer>Made by hand. <a href="/legal">Legal</a></footer></body></html>""",
    """<html><body><div class="topbar">Welcome, guest! <a href="/login">Log in</a> or <a href="/register">register</a></div><ul class="breadcrumb"><li><a href="/">Home</a></li><li><a href="/f">Finance</a></li></ul>
<div class="story" data-main><h1>Rates stay where they are</h1><div>The bank left its rate unchanged on Wednesday. Most people who were asked before had expected nothing else.</div><div>Prices rose by two percent in March, a little less than the month before, and wages by three.</div>
<div>Bonds hardly moved.</div></div><div class="promo">Try our app free for a month</div><div class="widget"><div><a href="/x">Bank shares fall</a></div><div><a href="/y">Five charts on wages</a></div><div><a href="/z">What a rate is</a></div></div>
<div class="disclaimer">Nothing on this page is advice. Please ask somebody who knows before you buy or sell.</div><div class="footer">About | Terms | Help</div></body></html>""",
    """<html><body><nav><a href="/">Home</a><a href="/p">Products</a><a href="/s">Support</a></nav><div class="hero-banner">The best tool for your team</div><section><div class="card"><a href="/1"><h3>Plan</h3><p>See what is next.</p></a></div>
<div class="card"><a href="/2"><h3>Share</h3><p>Show your work.</p></a></div></section><form class="contact"><label>Name</label><input><label>Message</label><textarea>Your message here</textarea><button>Send</button></form><footer><ul><li><a href="/j">Jobs</a></li><li><a href="/i">Imprint</a></li></ul></footer></body></html>""",
    """<html><body><div class="header"><h1>Village choir</h1></div><div class="nav"><ul><li>Concerts</li><li>Members</li><li>Guest book</li></ul></div><article class="post" data-main><header><h2>Spring concert</h2><time>12 April</time></header><p>We sang in the old barn this year, because the church has no roof at the moment. It was cold and it was lovely.</p>
<p>Thanks to everybody who brought soup.</p><footer>Posted in: Concerts</footer></article><div class="comments-area"><article class="comment"><p>A wonderful evening, thank you all so much for singing!</p></article></div><div class="sidebar"><p>Next rehearsal: Tuesday at eight, in the school. New voices are always welcome.</p></div></body></html>""",
)
